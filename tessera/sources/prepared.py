"""S8 with the payload stored once: token arrays, and locators per epoch.

A prepared dataset that writes every epoch's rows in feeding order holds the
token arrays as often as there are epochs.  Here they are written once, in the
order of the input, without any exchange.  What an epoch adds is an index of
narrow rows on two levels:

``payload/``
    the token arrays; each file is cut into row groups of ``GROUP_ROWS`` rows,
    and every row carries its row group's number ``_group`` (constant within a
    row group, so a filter on it skips row groups by their statistics and
    dictionaries);
``locators/[split=/]epoch=/rank=``
    a row's place in the feeding order and its locator: file, row group, offset;
``groups/[split=/]epoch=/rank=``
    which row groups a rank needs in an epoch, and how many rows of each.

A rank reads its ``groups`` first, then the payload of these row groups, and
joins it with its ``locators``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of a row group.  Files are cut by rows, so a group must stay below
#: Parquet's block size in bytes; 1,024 rows of four arrays of 512 ids are 8 MB.
GROUP_ROWS = 1024
#: Row groups of a file at most, and files numbered above them.
_GROUPS_OF_A_FILE = 1 << 28
#: Longest list of row groups in a scan's filter; a rank that needs more reads
#: all row groups and keeps its rows by the join.
LISTED_GROUPS = 10_000

LOCATOR = ("file", "row_group", "offset")


def write_payload(texts: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame], row_id: str = "row_id",
                  group_rows: int = GROUP_ROWS, mode: str = "error") -> None:
    """Encode ``texts`` and write the token arrays once.  ``encode`` must keep
    ``row_id``.  Rows stay where they are: no exchange, one file per task."""
    place = F.monotonically_increasing_id()  # task number above 33 bits of place within the task
    task, nth = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    group = task * _GROUPS_OF_A_FILE + F.floor(nth / group_rows).cast("bigint")
    (encode(texts).withColumn("_group", group).write.mode(mode)
     .option("parquet.block.row.count.limit", group_rows)
     .option("parquet.page.row.count.limit", min(group_rows, 20_000)).parquet(f"{path}/payload"))


def payload_locators(spark: SparkSession, path: str, row_id: str = "row_id", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``row_id`` and locator of every payload row, from a scan of two narrow columns."""
    rows = spark.read.parquet(f"{path}/payload")
    index = F.col("_metadata.row_index")
    return rows.select(row_id, F.col("_metadata.file_name").alias("file"), F.col("_group").alias("row_group"),
                       (index % group_rows).cast("int").alias("offset"))


def write_locators(spark: SparkSession, order: DataFrame, path: str, row_id: str = "row_id",
                   split_col: str | None = None, group_rows: int = GROUP_ROWS, mode: str = "error") -> None:
    """Write the index of ``order`` (``epoch, rank, pos_in_rank, row_id, ...``)
    over a written payload.  Only narrow rows are shuffled: once to meet their
    locators, and once to be cut by folder and place over many tasks.  More
    epochs can be added later (``mode="append"``) without touching the payload.

    Rows of ``order`` whose id the payload does not have raise an error.
    """
    keys = ([split_col] if split_col else []) + ["epoch", "rank"]
    found = order.join(payload_locators(spark, path, row_id, group_rows), row_id, "left")
    missing = F.raise_error(F.concat(F.lit("the payload has no row "), F.coalesce(F.col(row_id).cast("string"), F.lit("null"))))
    found = found.withColumn("file", F.when(F.col("file").isNull(), missing.cast("string")).otherwise(F.col("file")))
    rows = found.repartitionByRange(*keys, "pos_in_rank").sortWithinPartitions(*keys, "pos_in_rank")
    rows.write.mode(mode).partitionBy(*keys).parquet(f"{path}/locators")
    # the second level, from the locators as written: two narrow columns and a partial count
    level = spark.read.parquet(f"{path}/locators").groupBy(*keys, "file", "row_group").agg(F.count(F.lit(1)).alias("rows"))
    level.repartitionByRange(*keys, "row_group").write.mode("overwrite").partitionBy(*keys).parquet(f"{path}/groups")


def write_store(texts: DataFrame, order: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame],
                row_id: str = "row_id", split_col: str | None = None, group_rows: int = GROUP_ROWS) -> None:
    """Payload and locators in one call."""
    write_payload(texts, path, encode, row_id, group_rows)
    write_locators(texts.sparkSession, order, path, row_id, split_col, group_rows)


def _selected(rows: DataFrame, **values) -> DataFrame:
    for name, value in values.items():
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


def read_store(spark: SparkSession, path: str, epoch: int | None = None, rank: int | None = None, split: str | None = None,
               split_col: str = "split", row_id: str = "row_id", columns: list[str] | None = None) -> DataFrame:
    """The rows of one split, epoch and rank (or of all) in any order: the
    order's columns, then the payload's ``columns`` (default all).  Sort by
    ``pos_in_rank`` to feed.

    The payload's scan is filtered to the row groups that the second level
    lists, if they are at most ``LISTED_GROUPS``, so the others are not read.
    """
    chosen = {split_col: split, "epoch": epoch, "rank": rank}
    locators = _selected(spark.read.parquet(f"{path}/locators"), **chosen)
    payload = spark.read.parquet(f"{path}/payload")
    if any(v is not None for v in chosen.values()):
        groups = _selected(spark.read.parquet(f"{path}/groups"), **chosen).select("row_group").distinct()
        listed = [r[0] for r in groups.limit(LISTED_GROUPS + 1).collect()]
        if len(listed) <= LISTED_GROUPS:
            payload = payload.where(_any_of(F.col("_group"), sorted(listed)))
    payload = payload.select(row_id, *(columns or [c for c in payload.columns if c not in (row_id, "_group")]))
    return locators.drop(*LOCATOR).join(payload, row_id)


def _any_of(column: Column, values: list[int]) -> Column:
    """``column`` in ``values``, as ranges of neighbouring values: ranges are
    compared with each row group's least and greatest value."""
    ranges, found = [], F.lit(False)
    for v in values:
        if ranges and ranges[-1][1] == v - 1:
            ranges[-1][1] = v
        else:
            ranges.append([v, v])
    while len(ranges) > 1000:  # a long list of conditions costs more than some row groups too many
        ranges = [[a[0], b[1]] for a, b in zip(ranges[::2], ranges[1::2])] + ([ranges[-1]] if len(ranges) % 2 else [])
    parts = [column.between(a, b) for a, b in ranges]
    while len(parts) > 1:  # a balanced tree: the optimizer recurses
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0] if parts else found
