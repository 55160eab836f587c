"""Feeding: reproducible per-epoch order, rank shards and batches.

Positions never come from ``monotonically_increasing_id`` or ``rand``: the
order is ``md5(seed:epoch:row_id)`` with ``row_id`` as tie-break, so the
result does not depend on how the input is partitioned.  The global
``row_number`` is computed by :func:`tessera.operators.ordered.positions`
(range partitions plus per-partition offsets), never by a window without a
partition.  Only keys travel through the shuffles; encoded payloads are
joined back by ``row_id`` where they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera.operators.ordered import positions


def shuffle_position(df: DataFrame, epochs: int = 1, seed: int = 84, row_id: str = "row_id",
                     partition_cols: Sequence[str] = (), bucket_digits: int = 3) -> DataFrame:
    """O1 + W4: one row per (row, epoch) with ``pos`` = the row's place in
    that epoch's random order (per value of ``partition_cols``, e.g. a
    split).  Output ``(*partition_cols, epoch, row_id, pos, n_rows)``, where
    ``n_rows`` is the number of rows of that epoch (and split).

    The first ``bucket_digits`` hex digits of the md5 key cut every epoch
    into ``16 ** bucket_digits`` equal-sized buckets (uniform by
    construction, so no hot bucket); rows are numbered inside a bucket and
    shifted by the sizes of the earlier buckets.  Raise the digits as the
    data grows (3 digits: 4,096 buckets per epoch).
    """
    part = list(partition_cols)
    keyed = df.select(*part, row_id).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    keyed = keyed.withColumn("_key", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(row_id).cast("string"))))
    bucket = F.conv(F.substring("_key", 1, bucket_digits), 16, 10).cast("int")
    out = positions(keyed, order_cols=["_key", row_id], partition_cols=[*part, "epoch"], name="pos",
                    bucket=bucket, total="n_rows")
    return out.select(*part, "epoch", row_id, "pos", "n_rows")


def assign_rank(df: DataFrame, world_size: int, devices_per_node: int | None = None,
                pad: str = "wrap", row_id: str = "row_id",
                partition_cols: Sequence[str] = ("epoch",), count_col: str = "n_rows") -> DataFrame:
    """Divide positioned rows over ``world_size`` ranks.

    ``rank = pos % world_size``, ``pos_in_rank = pos div world_size``.
    With ``pad='wrap'`` the first rows of the order are repeated so that all
    ranks get the same number of rows (repeated again if there are fewer
    rows than ranks); the repeats are flagged ``is_padding``.  A row at
    position ``s`` of an epoch with ``n`` rows reappears at ``n + s``,
    ``2n + s``, ... below the padded total, so the repeats are made by a
    filter and an ``explode`` of the few rows concerned: no join and no
    broadcast.  The row count per epoch is read from ``count_col`` (added
    by :func:`shuffle_position`) or counted when the column is absent.
    """
    if world_size < 1:
        raise ValueError("world_size must be positive")
    part = list(partition_cols)
    out = df
    if pad == "wrap":
        if count_col not in df.columns:
            df = df.withColumn("_k", F.struct(*part))  # null keys are keys too
            counts = df.groupBy("_k").agg(F.count(F.lit(1)).alias(count_col))
            df = df.join(counts, "_k").drop("_k")
        n = F.col(count_col)
        total = F.ceil(n / F.lit(world_size)) * F.lit(world_size)
        base = df.withColumn("is_padding", F.lit(False))
        padded = (df.where(F.col("pos") + n < total)
                  .withColumn("pos", F.explode(F.sequence(F.col("pos") + n, (total - 1).cast("bigint"), n)))
                  .withColumn("is_padding", F.lit(True)))
        out = base.unionByName(padded.select(*base.columns))
    elif pad == "none":
        out = df.withColumn("is_padding", F.lit(False))
    else:
        raise ValueError("pad must be 'wrap' or 'none'")
    if count_col in out.columns:
        out = out.drop(count_col)
    out = out.withColumn("rank", (F.col("pos") % world_size).cast("int")).withColumn(
        "pos_in_rank", F.expr(f"pos div {world_size}"))
    if devices_per_node:
        out = out.withColumn("node_rank", F.expr(f"rank div {devices_per_node}").cast("int")).withColumn(
            "local_rank", (F.col("rank") % devices_per_node).cast("int"))
    return out


def assign_batch(df: DataFrame, batch_size: int) -> DataFrame:
    """``batch_id = pos_in_rank div batch_size``; the last batch of a rank
    may be short (no drop_last)."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return df.withColumn("batch_id", F.expr(f"pos_in_rank div {batch_size}"))


def collect_batches(df: DataFrame, keys: Sequence[str] = ("epoch", "rank", "batch_id"),
                    row_id: str = "row_id") -> DataFrame:
    """One row per batch with its row ids in feeding order.  A batch holds at
    most ``batch_size`` rows, so the collected list is bounded."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos_in_rank", row_id))),
                    lambda x: x[row_id]).alias("row_ids"))
