"""Continuous device utilisation (T1) and cross-rank step loss.

Both are windowed aggregations with a watermark: rows later than the
watermark are dropped, state older than it is evicted.  They run in
``update`` mode and every micro-batch appends its changed windows, tagged
with the batch id, to a Parquet table; :func:`latest` keeps the newest
version of each window.  That gives every window (also the ones still open
when an ``availableNow`` run ends, which ``append`` mode would hold back)
and stays exactly-once: a replayed batch overwrites its own folder with
the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.operators.telemetry import NUMERIC_FIELDS, monitor_fields
from tessera.functions.telemetry import parse_timestamp, to_number

MONITOR_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])

STEP_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("step", T.LongType()),
    T.StructField("phase", T.StringType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     source_key: str | None = None) -> DataFrame:
    """S4 as a stream: monitor log files appearing under ``path`` as
    ``(source, line_no, line)``.  A stream has no global line order, so
    ``line_no`` is null; the stream form of parsing is ``skip``.

    ``source`` is the file path, or with ``source_key`` the value of the
    ``<source_key>=<value>`` folder the file sits in (the layout
    :func:`tessera.sources.files.write_text_log` writes)."""
    r = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if source_key:  # the partition column, whose name is read unescaped
        r = r.schema(T.StructType([T.StructField("value", T.StringType()), T.StructField(source_key, T.StringType())]))
    src = F.col(source_key) if source_key else F.col("_metadata.file_path")
    return r.text(path).select(src.alias("source"),
                               F.lit(None).cast("bigint").alias("line_no"), F.col("value").alias("line"))


def device_max_stream(lines: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Parse a stream of monitor lines (malformed lines are skipped;
    the strict cut needs the whole log and has no stream form) and keep the
    maximum utilisation per device per tumbling window."""
    f = monitor_fields(lines, mode="skip")
    parsed = f.select("source", "device", parse_timestamp("timestamp").alias("ts"),
                      *[to_number(c).alias(c) for c in NUMERIC_FIELDS])
    return (parsed.where(F.col("ts").isNotNull())
            .withWatermark("ts", delay)
            .groupBy(F.window("ts", window).alias("w"), "source", "device")
            .agg(F.max("gpu_utilization").alias("max_gpu"),
                 F.max("gpu_memory_used").alias("max_gpu_memory"),
                 F.max("cpu_utilization").alias("max_cpu"),
                 F.max("ram_used").alias("max_ram"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "source", "device", "max_gpu", "max_gpu_memory", "max_cpu", "max_ram"))


def step_loss_stream(steps: DataFrame, window: str = "1 hour", delay: str = "1 hour",
                     places: int = 12, distinct: bool = False) -> DataFrame:
    """Mean loss over all ranks per run, phase, epoch and time window.
    With ``distinct`` a row that the feed repeats counts once (see
    :func:`tessera.streaming.stateful.once`)."""
    from tessera.functions.numeric import round_half_even
    from tessera.streaming.stateful import once
    rows = once(steps, delay=delay) if distinct else steps.withWatermark("ts", delay)
    return (rows
            .groupBy(F.window("ts", window).alias("w"), "run_id", "phase", "epoch")
            .agg(F.sum("loss").alias("_s"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "run_id", "phase", "epoch",
                    round_half_even(F.col("_s") / F.col("n"), places).alias("mean_loss"), "n"))


def run_to_table(agg: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, output_mode: str = "update"):
    """Run an aggregation, appending every micro-batch's changed rows with its
    ``batch_id`` under ``out_path``.  With ``available_now`` the call returns
    once all input present at start has been processed.

    A stream that runs for long should use ``output_mode='append'``: a window
    is then written once, when the watermark has closed it, so the table holds
    no older versions and is read as it is.  ``update`` also shows the open
    windows, at the price of :func:`latest` over all batches kept.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch, overwritten on a replay: idempotent
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{out_path}/batch_id={batch_id}")

    w = agg.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=processing_time or "10 seconds").start()


def latest(spark: SparkSession, out_path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every window written by :func:`run_to_table`."""
    t = spark.read.parquet(out_path)
    values = [c for c in t.columns if c not in keys and c != "batch_id"]
    best = t.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return best.select(*keys, *[F.col("_v")[c].alias(c) for c in values])
