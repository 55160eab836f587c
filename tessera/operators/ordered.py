"""Order-dependent helpers that never send one key to one task.

``Window.partitionBy(k).orderBy(o)`` moves every row of ``k`` into a single
task, and ``Window.orderBy(o)`` with no partition moves the whole table
there.  A hot key (a third of all rows) or a global order would then run on
one core.  The two helpers below keep the same results with bounded tasks:

* :func:`positions` gives ``row_number() - 1`` per key.  Rows are numbered
  inside bounded pieces (hash-prefix buckets, or sampled range partitions
  that split a hot key over many tasks); a running sum over the small
  per-piece count table gives each piece its offset.
* :func:`carry` gives the last (or next) non-null value per key in order by
  cutting the order column into fixed-width chunks: a window inside each
  chunk, plus a window over the small per-chunk table for values that come
  from an earlier (or later) chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.session import ensure_checkpoint_dir


def _cols(cs) -> list[str]:
    if cs is None:
        return []
    if isinstance(cs, str):
        return [cs]
    return list(cs)


def positions(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
              name: str = "pos", bucket: Column | None = None,
              num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row within ``partition_cols``
    in ``order_cols`` order (``row_number() over (...) - 1``).

    ``order_cols`` must be unique within a partition key, so that the order
    (and therefore the result) is the same on every recomputation.

    With ``bucket`` (a deterministic integer column that never decreases
    along the order, such as the leading hex digits of a hash key) the rows
    are numbered inside ``(partition, bucket)`` and shifted by the sizes of
    the earlier buckets; no data is materialised.  Without it the rows are
    range-partitioned by a sample of the keys, numbered in partition order
    and checkpointed to the shared checkpoint folder once, so that both
    uses of the numbered data see the same partitions.

    With ``total`` the number of rows of the row's partition key is added
    as that column (taken from the small count table, no extra pass).
    """
    part = _cols(partition_cols)
    order = _cols(order_cols)
    # one struct as the key: it is never null itself and equal nulls inside it
    # are equal, so rows with null keys join like all others
    df = df.withColumn("_k", F.struct(*part) if part else F.lit(0))
    if bucket is not None:
        b = df.withColumn("_b", F.coalesce(bucket.cast("bigint"), F.lit(-1).cast("bigint")))
        w = Window.partitionBy("_k", "_b").orderBy(*order)
        b = b.withColumn("_r", F.row_number().over(w) - 1)
        counts = b.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
        wc = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wc), F.lit(0)))
        counts = counts.withColumn("_tot", F.sum("_n").over(Window.partitionBy("_k"))).drop("_n")
        out = b.join(counts, ["_k", "_b"])
        out = out.withColumn(name, (F.col("_off") + F.col("_r")).cast("bigint"))
        out = out.withColumnRenamed("_tot", total) if total else out.drop("_tot")
        return out.drop("_k", "_b", "_r", "_off")

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in part + order]
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid", "_k").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    w = Window.partitionBy("_k").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    counts = counts.withColumn("_tot", F.sum("_n").over(Window.partitionBy("_k")))
    out = ranged.join(counts.select("_pid", "_k", "_off", "_mid0", "_tot"), ["_pid", "_k"])
    out = out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_mid0")).cast("bigint"))
    out = out.withColumnRenamed("_tot", total) if total else out.drop("_tot")
    return out.drop("_k", "_pid", "_mid", "_off", "_mid0")


def carry(df: DataFrame, value: Column | str, name: str, partition_cols: Sequence[str],
          order_col: str | Sequence[str], direction: str = "forward", inclusive: bool = True,
          chunk: int = 1 << 16, materialize: bool = True, chunk_by: str = "value") -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row
    (``direction='forward'``) or the first at or after it (``'backward'``),
    within ``partition_cols`` in ``order_col`` order.  With
    ``inclusive=False`` the row itself is not considered.

    ``order_col`` is one column or a list (a lexicographic order); its first
    column must be an integer and ``chunk`` is the width of the ranges of
    that column that are windowed on their own.

    ``chunk_by='value'`` cuts chunks by the value of the first order column
    (right for dense orders such as line numbers or epochs).  For sparse or
    clustered orders (hashed ids) use ``chunk_by='position'``: rows are first
    numbered densely per key (:func:`positions`, range partitions), so every
    chunk holds exactly ``chunk`` rows and a key of ``n`` rows has
    ``n / chunk`` chunks whatever its order values look like.

    The input is read by two branches (the window and the per-chunk table).
    With ``materialize`` (default) it is checkpointed once to the shared
    checkpoint folder, so the upstream plan (for example a corpus scan)
    runs once and survives the loss of executors.
    """
    part = _cols(partition_cols)
    order = _cols(order_col)
    v = F.col(value) if isinstance(value, str) else value
    fwd = direction == "forward"
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    if chunk_by == "value":
        base = df.withColumn("_v", v).withColumn("_ck", F.floor(F.col(order[0]) / F.lit(chunk)).cast("bigint"))
        if materialize:
            ensure_checkpoint_dir(df.sparkSession)
            base = base.checkpoint(eager=True)
    elif chunk_by == "position":
        # positions() range-partitions and checkpoints, so no second copy
        base = positions(df.withColumn("_v", v), order, part, name="_seq")
        base = base.withColumn("_ck", F.floor(F.col("_seq") / F.lit(chunk)).cast("bigint")).drop("_seq")
    else:
        raise ValueError("chunk_by must be 'value' or 'position'")
    # a backward carry is a forward carry in descending order: frames that
    # end at the current row are computed incrementally, while frames that
    # run to the end of the partition would be recomputed for every row
    o = [F.col(c) if fwd else F.col(c).desc() for c in order]
    ck_o = F.col("_ck") if fwd else F.col("_ck").desc()
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    w_in = Window.partitionBy(*part, "_ck").orderBy(*o).rowsBetween(*frame)
    w_all = Window.partitionBy(*part, "_ck").orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)
    inside = (base.withColumn("_in", F.last("_v", ignorenulls=True).over(w_in))
              .withColumn("_run", F.last("_v", ignorenulls=True).over(w_all)))

    # one row per (key, chunk): the value the chunk hands on (its last non-null
    # value in the carry direction), null for chunks without one
    edge_row = F.struct(*[F.col(c) for c in order], F.col("_run").alias("_h"))
    pick_edge = F.max if fwd else F.min
    per_chunk = inside.groupBy(*part, "_ck").agg(pick_edge(edge_row).alias("_edge"))
    w_ck = Window.partitionBy(*part).orderBy(ck_o).rowsBetween(Window.unboundedPreceding, -1)
    allck = per_chunk.select(*part, "_ck", F.last(F.col("_edge._h"), ignorenulls=True).over(w_ck).alias("_from"))
    # null-safe keys: a null key is a group of its own, and no inferred
    # ``isnotnull`` filter is pushed into the right side, whose shuffle then
    # stays identical to the left side's and is reused instead of repeated
    right = allck.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(part)],
                         F.col("_ck").alias("_rck"), "_from")
    cond = [inside[c].eqNullSafe(right[f"_r{i}"]) for i, c in enumerate(part)]
    cond.append(inside["_ck"].eqNullSafe(right["_rck"]))
    out = inside.join(right, cond, "left").drop(*[f"_r{i}" for i in range(len(part))], "_rck")
    return out.withColumn(name, F.coalesce(F.col("_in"), F.col("_from"))).drop("_v", "_ck", "_in", "_run", "_from")
