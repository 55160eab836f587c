"""Helpers shared by the training-data operators.

Intermediate tables are written as Parquet to the folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor costs the recomputation
of one stage at most.  ``tessera.session`` removes the folders of a process
when its Python ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import forget_staged, staging_path, table_path

#: A word of the contracts: a run of anything but ASCII white space.  In Python
#: ``bytes.split()`` splits at exactly the same six characters.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast up to this many (narrow) rows, counted first.
BROADCAST_ROWS = 200_000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Rows of an Arrow batch: whole texts are large, and a Python worker holds a
#: batch in several forms at once.
ARROW_ROWS = 1000
ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself; its session sends Python at most ``ARROW_ROWS`` rows at a
    time from now on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_KEY)) <= ARROW_ROWS:
        conf.set(ARROW_KEY, str(ARROW_ROWS))
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = staging_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folders of a :func:`staged` table (or a union of such) that
    nothing reads any more."""
    forget_staged(df.sparkSession, {f.rpartition("/")[0] for f in df.inputFiles()})


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``;
    beyond that it stays a shuffled join side."""
    return F.broadcast(df) if rows <= limit else df


def runs(sizes: list[int], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Cut ``0..len(sizes)`` into runs of at most ``limit`` bytes (one item at
    least), so that a batch of long texts is worked off piece by piece."""
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def give_back() -> None:
    """Return to the system what this Python worker has freed.  Arrow's pool and
    malloc keep it otherwise, and a worker outlives the stage that needed it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: one row ``(node, component)``
    per node that has an edge, where ``component`` is its smallest reachable id.

    Each round lets every node point at its smallest neighbour, follows the
    pointers to their roots by doubling, and contracts the edges to the roots.
    Only minima are aggregated per key and only equi-joins are used, so a hub
    with millions of edges is no bottleneck and nothing reaches the driver but
    the answer to "is anything left".
    """
    spark = edges.sparkSession
    left = staged(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    member = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")), "pointers")
        while True:
            up = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            step = staged(point.join(up, "root").select(
                "node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")),
                "pointers")
            point = step.select("node", "root")
            if step.where("moved").isEmpty():
                break
        if member is None:
            member = point
        else:
            up = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            member = member.join(up, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root"))
        ra = point.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = point.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = staged(left.join(ra, "a").join(rb, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if member is None:
        return spark.createDataFrame([], "node bigint, component bigint")
    return member.select("node", F.col("root").alias("component"))
