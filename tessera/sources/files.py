"""File sources and sinks.

Schemas are explicit everywhere (no inference pass over the data); text
logs are read line by line and numbered per file without sending a file to
one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tessera.session import ensure_checkpoint_dir
from tessera.sources.quoted_csv import read_quoted_csv


def read_pairs_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   columns: Sequence[str] = ("source_text", "target_text"),
                   keep: Sequence[str] = ()) -> DataFrame:
    """CSV with a header line, quoted multi-line fields, ``"`` escapes.

    Without ``schema`` columns are taken by their header names, as strings
    (no inference pass), and only ``columns`` plus ``keep`` are returned,
    in that order; any other column of the file is ignored and the order of
    columns in the file does not matter.  With ``schema`` the file must have
    exactly those columns.  A malformed record fails the job (FAILFAST)
    instead of turning into nulls.  A large file is read by many tasks (see
    :mod:`tessera.sources.quoted_csv`).
    """
    df = read_quoted_csv(spark, path, schema)
    if schema is not None:
        return df
    wanted = list(columns) + [c for c in keep if c not in columns]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"CSV at {path} has no column(s) {missing}; header: {df.columns}")
    return df.select(*wanted)


def write_pairs_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and no index column (what ``to_csv(index=False)``
    writes); quotes and embedded line feeds survive a read with S1."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_split_corpus(spark: SparkSession, path: str, split_col: str = "split",
                      fmt: str = "parquet") -> DataFrame:
    """S3: a corpus stored as ``path/split=<name>/*.parquet`` (``fmt='parquet'``)
    or as text files under ``path/<split>/`` (``fmt='text'``).  Parquet
    folders give ``split`` through partition discovery; for text each file
    becomes one document ``(path, split, text)``."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "text":
        raise ValueError("fmt must be 'parquet' or 'text'")
    # ``wholetext`` must be the argument of ``text()``: that method passes its
    # own ``wholetext=False`` default, which overrides an earlier ``option``
    docs = spark.read.text(f"{path}/*/", wholetext=True)
    parent = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return docs.select(F.col("_metadata.file_path").alias("path"), parent.alias(split_col),
                       F.col("value").alias("text"))


def read_text_lines(spark: SparkSession, path: str, source_col: str = "source",
                    source: str | None = None, only: Sequence[str] | None = None,
                    materialize: bool = True) -> DataFrame:
    """Text files as ``(source, line_no, line)`` with ``line_no`` counted
    from 0 per source, split on line feed only.

    By default every file is a source of its own (``source`` = its path).
    With ``source`` (a partition column such as the ``source=`` folder of a
    partitioned write) the files of one source are one log, numbered
    across its files in file-name order (``part-00000``, ``part-00001``,
    ... or ``log.000``, ``log.001``, ... of a rotated log).

    Big files are split into blocks read by different tasks.  Within a task
    a block's lines arrive in file order, so a line's number is the block's
    offset (lines in earlier files and blocks of the source, a running sum
    over the small per-block count table) plus its index in the block.

    ``only`` names the sources to read; the others' folders are not scanned (a
    filter on the result cannot be pushed below the numbering).  The lines are
    used twice, for the counts and for the result; ``materialize`` checkpoints
    them once, so that both uses see the same file blocks whatever the cluster
    looks like at either time.
    """
    file = F.col("_metadata.file_path")
    text = spark.read.option("lineSep", "\n").text(path)
    if only is not None:
        text = text.where((F.col(source) if source else file).isin(list(only)))
    raw = (text.select((F.col(source) if source else file).alias(source_col),
                   file.alias("_file"),
                   F.col("_metadata.file_block_start").alias("_blk"),
                   F.monotonically_increasing_id().alias("_mid"),
                   F.col("value").alias("line")))
    if materialize:
        ensure_checkpoint_dir(spark)
        raw = raw.checkpoint(eager=True)
    keys = [source_col, "_file", "_blk"]
    blocks = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    w = Window.partitionBy(source_col).orderBy("_file", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    out = raw.join(blocks, keys)
    return out.select(source_col, (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias("line_no"), "line")


def write_text_log(log: DataFrame, path: str, source: str = "source", line_no: str = "line_no",
                   line: str = "line", mode: str = "overwrite") -> None:
    """Write ``(source, line_no, line)`` as text under ``path/source=<s>/``,
    the form :func:`read_text_lines` reads back with ``source='source'``.

    Range partitions on ``(source, line_no)`` cut a long log over many
    tasks; each writes one file of consecutive lines, and file names grow
    with the range, so file-name order is line order."""
    (log.repartitionByRange(source, line_no).sortWithinPartitions(source, line_no)
     .select(source, line).write.mode(mode).partitionBy(source).text(path))


def read_banners(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """One banner text per file (a banner is a few KB), as ``(source,
    text)``.  ``source``: a partition column naming the host (default: the
    file path)."""
    src = F.col(source) if source else F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(
        src.alias("source"), F.col("value").alias("text"))


def read_inventory(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Inventory lines as ``(source, line)``.  ``source``: a partition
    column naming the host (default: the file path)."""
    src = F.col(source) if source else F.col("_metadata.file_path")
    return spark.read.option("lineSep", "\n").text(path).select(
        src.alias("source"), F.col("value").alias("line"))


def write_text_by_source(df: DataFrame, path: str, text: str, source: str = "source",
                         mode: str = "overwrite") -> None:
    """Write one text column as files under ``path/source=<s>/`` (what a
    capture of each host's tool output looks like)."""
    df.select(source, text).write.mode(mode).partitionBy(source).text(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row."""
    df.write.mode(mode).json(path)


def write_variant(records: DataFrame, path: str, record: str, mode: str = "overwrite") -> None:
    """JSON texts as one VARIANT column ``record`` in Parquet, whatever
    their shapes; the other columns as they are.  A text that is no JSON fails."""
    others = [c for c in records.columns if c != record]
    records.select(*others, F.parse_json(record).alias("record")).write.mode(mode).parquet(path)


def read_variant(spark: SparkSession, path: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Fields of :func:`write_variant`'s records by path: ``fields`` maps a name to
    ``(path, type)``, such as ``("$.devices[0].name", "string")``.  A record
    without the path has null there, and so has one whose value does not fit."""
    rows = spark.read.parquet(path)
    return rows.select(*keep, *[F.try_variant_get("record", at, kind).alias(name) for name, (at, kind) in fields.items()])


def write_prepared(texts: DataFrame, order: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame],
                   row_id: str = "row_id", split_col: str | None = None, mode: str = "overwrite") -> None:
    """The prepared dataset, one folder of token arrays per rank.

    ``texts`` (one row per example) meets ``order`` (``epoch, rank,
    pos_in_rank, row_id, ...``) by ``row_id``; the rows, still as text, go
    through one range exchange on (split, epoch, rank, pos_in_rank), which cuts
    a large rank over many tasks, and are encoded behind it.  ``encode`` maps a
    frame to its token columns and must keep the columns of ``order``.  Files
    lie under ``path/[split=s/]epoch=e/rank=r`` in feeding order, so a trainer
    process reads its own folder and nothing else.
    """
    keys = ([split_col] if split_col else []) + ["epoch", "rank"]
    rows = order.join(texts, row_id)
    rows = rows.repartitionByRange(*keys, "pos_in_rank").sortWithinPartitions(*keys, "pos_in_rank")
    encode(rows).write.mode(mode).partitionBy(*keys).parquet(path)


def read_prepared(spark: SparkSession, path: str, epoch: int | None = None, rank: int | None = None,
                  split: str | None = None, split_col: str = "split") -> DataFrame:
    """Read what :func:`write_prepared` wrote: all of it, or the folder of one
    split, epoch and rank.  Rows carry ``pos_in_rank``; sort by it to feed."""
    rows = spark.read.parquet(path)
    for col, value in ((split_col, split), ("epoch", epoch), ("rank", rank)):
        if value is not None:
            rows = rows.where(F.col(col) == value)
    return rows
