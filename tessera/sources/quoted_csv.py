"""S1 for large files: quoted CSV read by many tasks per file.

A quoted field may hold line feeds, so where a record starts depends on every
quote before it, and the usual way out (``multiLine``) gives a whole file to
one task.  Here the file is read as lines, which Spark splits into blocks:

1. every block counts its quotes, in parallel; only the parity matters, since
   an escaped quote is two;
2. a running XOR over the small table of blocks says for each block whether it
   starts inside a quoted field;
3. every block then joins its lines to records on its own.  Only the pieces of
   the records that cross a block border, two for each block at most, are
   shuffled and put together;
4. records are parsed by ``from_csv`` in the JVM.

The text itself never goes through an exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tessera.session import staging_path

QUOTE = '"'
#: Options of ``from_csv``.  ``multiLine`` keeps line ends within quotes as they are.
CSV_OPTIONS = {"escape": QUOTE, "mode": "FAILFAST", "multiLine": "true"}
#: Blocks that start inside quotes are broadcast up to this many (counted).
BROADCAST_BLOCKS = 500_000

PIECE = "file string, block bigint, kind int, first boolean, text string"
RECORD, START, INSIDE, END = range(4)


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_parity(lines: DataFrame) -> DataFrame:
    """``(file, block, odd, opens)``: the parity of a block's quotes, and
    whether it starts inside quotes.

    One row per block is shuffled; the window runs over the blocks of a file.
    """
    odd = F.length(F.regexp_replace("value", f"[^{QUOTE}]", "")) % 2
    blocks = lines.groupBy("file", "block").agg(F.bit_xor(odd).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("opens", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)


def _assembled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one block after the other, in file order, to records and pieces."""
    columns = ["file", "block", "kind", "first", "text"]
    here, inside, continued, first, held = None, False, False, False, []

    def left_over() -> list[tuple]:
        # what the end of a block cuts off: the start of a record, or the inside of one
        return [(*here, INSIDE if continued else START, first, "\n".join(held))] if held else []

    for batch in batches:
        out = []
        for file, block, opens, line in zip(batch["file"], batch["block"], batch["opens"], batch["value"]):
            if (file, block) != here:
                out += left_over()
                here, inside, continued, first, held = (file, block), bool(opens), bool(opens), block == 0, []
            held.append(line)
            if line.count(QUOTE) % 2:
                inside = not inside
            if not inside:
                out.append((*here, END if continued else RECORD, first, "\n".join(held)))
                continued, first, held = False, False, []
        yield pd.DataFrame(out, columns=columns)
    if here is not None:
        yield pd.DataFrame(left_over(), columns=columns)


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records of quoted CSV files: ``(file, block, first, text)``, where
    ``block`` is the offset of the block that the record starts in and ``first``
    marks a file's first record (the header, if it has one).

    Lines end with a line feed, or with a carriage return and a line feed.  A
    quote stands only around a field or, doubled, inside one.  A file whose
    quotes do not pair up raises ``ValueError``.  Blank records are left out.
    """
    lines = _lines(spark, path)
    at = staging_path(spark, "csv-blocks")
    block_parity(lines).write.parquet(at)
    blocks = spark.read.parquet(at)
    torn = blocks.groupBy("file").agg(F.bit_xor("odd").alias("odd")).where("odd = 1").select("file").take(3)
    if torn:
        raise ValueError(f"quotes are not closed in {[r['file'] for r in torn]}")
    open_blocks = blocks.where("opens").select("file", "block", "opens")
    opens = F.coalesce("opens", F.lit(False)).alias("opens")
    if open_blocks.count() <= BROADCAST_BLOCKS:
        lines = lines.join(F.broadcast(open_blocks), ["file", "block"], "left").select("file", "block", opens, "value")
    else:  # a shuffle loses the order of a block's lines; it is restored
        lines = lines.withColumn("nth", F.monotonically_increasing_id()).join(open_blocks, ["file", "block"], "left")
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "nth").select(
            "file", "block", opens, "value")
    pieces = lines.mapInPandas(_assembled, PIECE)
    whole = pieces.where(F.col("kind") == RECORD).select("file", "block", "first", "text")

    # the pieces of one record: a START, whole blocks INSIDE it, and the next END.
    # A block has its END before its START.
    starts = F.col("kind") == START
    cut = pieces.where(F.col("kind") != RECORD).withColumn(
        "nth", F.sum(starts.cast("int")).over(Window.partitionBy("file").orderBy("block", starts)))
    joined = cut.groupBy("file", "nth").agg(F.min("block").alias("block"), F.bool_or("first").alias("first"), F.array_sort(
        F.collect_list(F.struct("block", "text"))).alias("parts"))
    joined = joined.select("file", "block", "first", F.concat_ws("\n", F.transform("parts", lambda p: p["text"])).alias("text"))
    text = F.regexp_replace("text", "\r$", "")
    text = F.when(F.col("first"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    return whole.unionByName(joined).withColumn("text", text).where("text <> ''")


def header_names(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The column names of the first file's header."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", QUOTE).csv(path).columns


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Quoted CSV files with a header each, as rows of ``schema`` (default: the
    header's columns, as strings).

    Every file must have that header: another one fails the job, and so does a
    record that does not fit the schema.  Empty cells are null.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header_names(spark, path)])
    records = read_records(spark, path)
    cells = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(schema))), CSV_OPTIONS)
    header = F.array(*[F.coalesce(cells[f"c{i}"], F.lit("")) for i in range(len(schema))])
    wanted = F.array(*[F.lit(n) for n in schema.names])
    told = F.raise_error(F.concat(F.lit(f"the header is not {schema.names}: "), "text", F.lit(" in "), "file"))
    checked = records.where(~F.col("first") | F.when(header == wanted, F.lit(False)).otherwise(told.cast("boolean")))
    return checked.select(F.from_csv("text", _ddl(schema), CSV_OPTIONS).alias("row")).select(
        *[F.col("row")[n].alias(n) for n in schema.names])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
