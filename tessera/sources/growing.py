"""S4 for logs that grow and rotate: each run reads only what is new.

A folder ``root`` remembers what has been read:

``files/run=n``
    the manifest after run n, one row per file: ``source``, ``seq`` (its place
    among the source's files), ``file``, ``size`` (bytes read so far), ``lines``
    (read so far) and ``head`` (its first bytes, by which a renamed file is
    known again);
``lines/run=n``
    the lines that run n read, numbered within the chunk they were read from;
``chunks/run=n``
    the number of each chunk's first line in its source.

A run compares the manifest with the files that are there, cuts the bytes that
are new into chunks, reads them in parallel and writes its three tables, the
manifest last.  A run that is lost half way leaves no manifest and is simply
done again over the same folders.  Lines are written once and never shuffled.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Bytes of a chunk, the unit of parallel reading.
CHUNK = 32 << 20
#: First bytes of a file that tell it from others.
HEAD = 512
BATCH_LINES = 5_000

MANIFEST = "source string, seq bigint, file string, size bigint, lines bigint, head binary"


def _open(path: str):
    """A file of any file system that pyarrow knows, for buffered reading."""
    from pyarrow import fs

    if path.startswith("file:"):
        system, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif "://" in path:
        system, name = fs.FileSystem.from_uri(path)
    else:
        system, name = fs.LocalFileSystem(), path
    return io.BufferedReader(system.open_input_file(name), 1 << 20)


def last_run(spark: SparkSession, root: str) -> int:
    """The number of the last run that was finished, 0 if there is none."""
    try:
        return spark.read.parquet(f"{root}/files").agg(F.max("run")).first()[0] or 0
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "UNABLE_TO_INFER_SCHEMA" in (e.getCondition() or ""):
            return 0
        raise


def _files(spark: SparkSession, path: str, source: str | None) -> DataFrame:
    """``(source, file, size, head)`` of the files that are there; contents are
    not read but for the heads."""
    there = spark.read.format("binaryFile").load(path)
    there = there.select((F.col(source).cast("string") if source else F.col("path")).alias("source"),
                         F.col("path").alias("file"), F.col("length").alias("size")).where("size > 0")

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for name in b["file"]:
                with _open(name) as f:
                    found.append(f.read(HEAD))
            yield b.assign(head=found)

    return there.mapInPandas(heads, "source string, file string, size bigint, head binary")


def matched(there: DataFrame, known: DataFrame) -> DataFrame:
    """``(source, file, size, head, seq, read, lines)`` of the files that are
    there: what is known of each (``seq`` null and ``read`` 0 for a new file).

    A file is a known one if it has its name, begins with its head and is no
    shorter; or, renamed by a rotation, if it begins with the same ``HEAD``
    bytes as a known file whose name now belongs to another or to none.  A file
    cut down to nothing and written anew is a new one.
    """
    k = known.select(F.col("source").alias("ks"), F.col("file").alias("kf"), F.col("size").alias("read"), "lines",
                     F.col("head").alias("kh"), "seq")
    newest = Window.partitionBy("ks", "kf").orderBy(F.col("seq").desc())
    k = k.withColumn("newest", F.row_number().over(newest) == 1)
    same = there.join(k.where("newest"), (F.col("source") == F.col("ks")) & (F.col("file") == F.col("kf"))
                      & (F.substring("head", F.lit(1), F.length("kh")) == F.col("kh")) & (F.col("size") >= F.col("read")))
    same = same.select("source", "file", "size", "head", "seq", "read", "lines")
    rest = there.join(same.select("source", "file"), ["source", "file"], "left_anti")
    open_ = k.join(same.select(F.col("source").alias("ks"), "seq"), ["ks", "seq"], "left_anti").where(F.length("kh") == HEAD)
    moved = rest.join(open_, (F.col("source") == F.col("ks")) & (F.col("head") == F.col("kh")) & (F.col("size") >= F.col("read")))
    first = [F.row_number().over(Window.partitionBy("source", "file").orderBy(F.col("seq").desc())) == 1,
             F.row_number().over(Window.partitionBy("source", "seq").orderBy("file")) == 1]
    moved = moved.withColumn("a", first[0]).where("a").withColumn("b", first[1]).where("b")
    moved = moved.select("source", "file", "size", "head", "seq", "read", "lines")
    new = rest.join(moved.select("source", "file"), ["source", "file"], "left_anti").select(
        "source", "file", "size", "head", F.lit(None).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("read"),
        F.lit(0).cast("bigint").alias("lines"))
    return same.unionByName(moved).unionByName(new)


def chunks(files: DataFrame, known: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(source, seq, file, read, size, start, stop)``: the new bytes, cut into
    chunks.  New files come behind the known ones of their source, by name."""
    last = known.groupBy("source").agg(F.max("seq").alias("last"))
    nth = F.row_number().over(Window.partitionBy("source", F.col("seq").isNull()).orderBy("file"))
    files = files.withColumn("nth", nth).join(last, "source", "left")
    files = files.withColumn("seq", F.coalesce("seq", F.coalesce("last", F.lit(0)) + F.col("nth")))
    new = files.where(F.col("size") > F.col("read"))
    start = F.explode(F.sequence("read", F.col("size") - 1, F.lit(chunk).cast("bigint")))
    new = new.withColumn("start", start)
    return new.select("source", "seq", "file", "read", "size", "start", F.least(F.col("start") + chunk, "size").alias("stop"))


LINES = "source string, seq bigint, start bigint, nth bigint, line binary, next bigint"


def lines_of(file, read: int, size: int, start: int, stop: int, final: bool) -> Iterator[tuple[bytes, int]]:
    """The lines that begin in ``start .. stop`` of an open file, each with the
    place behind it.  ``read`` is a line's beginning; nothing behind ``size`` is
    looked at.  A last line without a line feed only counts if ``final``."""
    at = start
    if start > read:  # the line that is cut by the chunk's border belongs to the chunk before
        file.seek(start - 1)
        at = start - 1 + len(file.readline(size - start + 1))
    else:
        file.seek(start)
    while at < stop:
        line = file.readline(size - at)
        if not line or not (line.endswith(b"\n") or final):
            return
        at += len(line)
        yield line[:-1] if line.endswith(b"\n") else line, at


def _reader(final: bool):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source", "seq", "start", "nth", "line", "next"]
        for b in batches:
            for c in b.itertuples():
                out, nth = [], 0
                with _open(c.file) as f:
                    for line, end in lines_of(f, c.read, c.size, c.start, c.stop, final):
                        out.append((c.source, c.seq, c.start, nth, line, end))
                        nth += 1
                        if len(out) >= BATCH_LINES:
                            yield pd.DataFrame(out, columns=columns)
                            out = []
                yield pd.DataFrame(out, columns=columns)

    return work


def ingest(spark: SparkSession, path: str, root: str, source: str | None = "source", final: bool = False,
           chunk: int = CHUNK) -> int:
    """Read what has been added to the logs at ``path`` since the last run and
    return this run's number.

    ``source`` is the partition column that names a log (its folder
    ``source=<name>``), whose files are numbered through in the order they were
    first seen, those of one run by name; without it every file is a log.  A
    last line without a line feed is left for a later run unless ``final``.
    Files that have gone stay in the manifest, so their lines go on counting.
    """
    run = last_run(spark, root) + 1
    known = (spark.read.schema(MANIFEST).parquet(f"{root}/files/run={run - 1}") if run > 1
             else spark.createDataFrame([], MANIFEST))
    files = matched(_files(spark, path, source), known)
    new = chunks(files, known, chunk)
    # what a lost executor reads again must be the same bytes: sizes are settled here
    at = f"{root}/plan/run={run}"
    new.write.mode("overwrite").parquet(at)
    new = spark.read.schema(new.schema).parquet(at)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = new.repartition(parts, "source", "seq", "start").mapInPandas(_reader(final), LINES)
    text.withColumn("line", F.col("line").cast("string")).write.mode("overwrite").parquet(f"{root}/lines/run={run}")
    seen = spark.read.schema(LINES).parquet(f"{root}/lines/run={run}").groupBy("source", "seq", "start").agg(
        F.count(F.lit(1)).alias("n"), F.max("next").alias("next"))

    lines = known.groupBy("source").agg(F.sum("lines").alias("before"))
    order = Window.partitionBy("source").orderBy("seq", "start").rowsBetween(Window.unboundedPreceding, -1)
    based = seen.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).join(lines, "source", "left").select(
        "source", "seq", "start", "n", "next", (F.col("base") + F.coalesce("before", F.lit(0))).alias("base"))
    based.write.mode("overwrite").parquet(f"{root}/chunks/run={run}")

    based = spark.read.parquet(f"{root}/chunks/run={run}")
    added = based.groupBy("source", "seq").agg(F.sum("n").alias("n"), F.max("next").alias("next"))
    named = new.select("source", "seq", "file").distinct()
    there = files.select("source", "file", F.col("head").alias("now"))
    rows = known.join(named.withColumnRenamed("file", "new_file"), ["source", "seq"], "full").join(
        added, ["source", "seq"], "left").withColumn("file", F.coalesce("new_file", "file"))
    rows = rows.join(there, ["source", "file"], "left").select(
        "source", "seq", "file", F.coalesce("next", "size", F.lit(0)).cast("bigint").alias("size"),
        (F.coalesce("lines", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("lines"),
        F.when(F.col("new_file").isNotNull(), F.col("now")).otherwise(F.col("head")).alias("head"))
    rows.write.mode("overwrite").parquet(f"{root}/files/run={run}")
    return run


def planned_bytes(spark: SparkSession, root: str, run: int) -> int:
    """How many bytes a run was to read."""
    return spark.read.parquet(f"{root}/plan/run={run}").agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0


def read_ingested(spark: SparkSession, root: str, since: int = 0, source_col: str = "source") -> DataFrame:
    """``(source, line_no, line)`` of all finished runs, or of those after run
    ``since``.  The table of chunks is small, one row for each ``CHUNK`` bytes."""
    upto = last_run(spark, root)
    if not upto:
        return spark.createDataFrame([], f"{source_col} string, line_no bigint, line string")
    keep = (F.col("run") > since) & (F.col("run") <= upto)
    base = spark.read.parquet(f"{root}/chunks").where(keep).select("run", "source", "seq", "start", "base")
    rows = spark.read.parquet(f"{root}/lines").where(keep).join(base, ["run", "source", "seq", "start"])
    return rows.select(F.col("source").alias(source_col), (F.col("base") + F.col("nth")).alias("line_no"), "line")
