"""Test inputs F1-F5, derived from the driver tables by DataFrame code.

Each builder reads the given parquet tables, so its work grows with them.
The shapes follow the inputs of the original pipelines; the values come from
the driver's synthetic tables (see FIXTURES.md for the same recipes in SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators.ordered import positions
from tessera.session import table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, grp, split, text)``; each text gets a heading line,
    blank lines, a CRLF with NBSP, or a fullwidth-colon line by ``doc_id % 5``."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    doc = F.col("doc_id")
    sid = doc.cast("string")
    m5 = doc % 5
    suffix = (
        F.when(m5 == 0, F.concat(F.lit("\n  Heading "), sid, F.lit(":  \n")))
        .when(m5 == 1, F.lit("\n\n\t \n"))
        .when(m5 == 2, F.concat(F.lit("\r\ntail "), sid, F.lit("\u00a0")))
        .when(m5 == 3, F.lit("\nstop\uff1a"))
        .otherwise(F.lit(""))
    )
    split = (
        F.when(doc % 10 == 8, F.lit("validation"))
        .when(doc % 10 == 9, F.lit("test"))
        .otherwise(F.lit("train"))
    )
    return d.select(doc.alias("doc_id"), F.col("source").alias("grp"), split.alias("split"),
                    F.concat(F.col("text"), suffix).alias("text"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, source_text, target_text)``: each user turn with the
    assistant turn that follows it.  The equi-join on ``(conv_id, turn)``
    keeps even a huge conversation spread over many tasks."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
        F.col("text").alias("source_text"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("target_text"))
    return u.join(a, ["conv_id", "turn"]).select("row_id", "source_text", "target_text")


def monitor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, line_no, line)``: monitor lines of three hosts.

    host0 is well formed; host1 has two devices, so every tick first prints
    a five-field line; the last line of host2 is cut off.
    """
    e = read(spark, sf_dir, "events").select(
        "event_id", "ts", "value", (F.col("user_id") % 3).alias("_h"))
    # the host's row count comes with the positions: its last line is n - 1
    e = positions(e, order_cols=["ts", "event_id"], partition_cols=["_h"], name="line_no", total="_n")
    e = e.withColumn("_last", F.col("_n") - 1)
    eid = F.col("event_id")
    source = F.concat(F.lit("host"), F.col("_h").cast("string"))
    ts_text = F.concat(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.lit("."),
                       F.lpad((eid % 1000).cast("string"), 3, "0"))
    gpu = (F.floor("value").cast("int") % 101).cast("string")
    mem = ((eid * 37) % 16160).cast("string")
    cpu = (((eid * 7) % 1000) / F.lit(10.0)).cast("string")
    ram = (F.lit(1000) + (eid * 13) % 60000).cast("string")
    host1 = F.col("_h") == 1
    dev_no = F.when(host1, F.lit(2)).otherwise(eid % 2).cast("string")
    line = (
        F.when((F.col("_h") == 2) & (F.col("line_no") == F.col("_last")),
               F.lit("00000000:00:01.0, 2024/0"))
        .when(host1 & (F.col("line_no") % 2 == 0),
              F.concat_ws(", ", F.lit("00000000:00:01.0"), ts_text, gpu, mem, F.lit("16160")))
        .otherwise(F.concat_ws(", ", F.concat(F.lit("00000000:00:0"), dev_no, F.lit(".0")),
                               ts_text, gpu, mem, F.lit("16160"), cpu, ram, F.lit("61440")))
    )
    return e.select(source.alias("source"), "line_no", line.alias("line"))


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, rank, epoch, step, phase, loss, ts)`` step losses."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "value", "user_id", "event_type")
    e = e.select(
        (F.col("user_id") % 20).alias("run_id"),
        (F.col("event_id") % 4).cast("int").alias("rank"),
        (F.expr("event_id div 20") % 6).cast("int").alias("epoch"),
        F.when(F.col("event_type") == "error", F.lit("val")).otherwise(F.lit("train")).alias("phase"),
        (F.col("value") / F.lit(100.0)).alias("loss"),
        "ts", "event_id")
    # event_id is a unique integer: a bucket of 2**16 consecutive ids holds at
    # most 2**16 rows whatever the key skew, so no sampling is needed
    e = positions(e, order_cols=["event_id"], partition_cols=["run_id", "rank", "epoch", "phase"], name="step",
                  bucket=F.expr("event_id div 65536"))
    return e.select("run_id", "rank", "epoch", "step", "phase", "loss", "ts")


REPORT_SCHEMA = "run_id bigint, epoch int, rank int, value double"


def rank_reports(spark: SparkSession, sf_dir: str, ranks: int, epochs: int) -> DataFrame:
    """F4 as a live feed of epoch ends: every rank's mean validation loss, null
    where it had no validation step."""
    val = step_metrics(spark, sf_dir)
    runs = val.select("run_id").distinct()
    grid = runs.select("run_id", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")).select(
        "run_id", "epoch", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"))
    mean = val.where("phase = 'val'").groupBy("run_id", "epoch", "rank").agg(F.avg("loss").alias("value"))
    return grid.join(mean, ["run_id", "epoch", "rank"], "left").select("run_id", "epoch", "rank", "value")


def diverged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 with NaN, infinite and very large losses in some runs: by step and run."""
    x = step_metrics(spark, sf_dir)
    run, step = F.col("run_id"), F.col("step")
    loss = (F.when((run % 5 == 1) & (step % 7 == 3), F.lit(float("nan")))
            .when((run % 5 == 2) & (step % 7 == 3), F.lit(float("inf")))
            .when((run % 5 == 3) & (step % 2 == 1), F.lit(float("-inf")))
            .when(run % 5 == 4, F.floor(F.col("loss") * 8) / 8.0 + F.lit(2.5e8)).otherwise(F.col("loss")))
    return x.withColumn("loss", loss)


def steps_of_all_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 with four more losses per first step of an epoch: 2^900, -2^900, 2^-900
    and -2^-901."""
    x = step_metrics(spark, sf_dir).select("run_id", "rank", "epoch", "phase", "step", "loss")
    more = F.array(*[F.lit(v) for v in (2.0 ** 900, -(2.0 ** 900), 2.0 ** -900, -(2.0 ** -901))])
    return x.unionByName(x.where("step = 0").withColumn("loss", F.explode(more)))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(example_id, logits ARRAY<FLOAT>, label INT)``."""
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("example_id"), F.col("embedding").alias("logits"), "label")


def inventory_lines(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Inventory text (``name, bus id, memory``) of every device seen in the
    F3 log, one line per device and host."""
    from tessera.operators.telemetry import monitor_fields
    f = monitor_fields(log if log is not None else monitor_log(spark, sf_dir), mode="skip")
    devs = f.select("source", "device", "gpu_memory_total").distinct()
    line = F.concat_ws(", ", F.concat(F.lit("GPU "), F.col("source")), F.col("device"),
                       F.concat(F.col("gpu_memory_total"), F.lit(" MiB")))
    return devs.select("source", line.alias("line"))


def driver_banners(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Banner text per F3 host; host2's banner has no version (error row).
    The version numbers come from the host's line count."""
    n = (log if log is not None else monitor_log(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    text = (
        F.when(F.col("source") == "host2",
               F.lit("NVIDIA-SMI has failed because it couldn't communicate with the driver."))
        .otherwise(F.concat(
            F.lit("| NVIDIA-SMI 470.57.02    Driver Version: 470.57."), (F.col("n") % 100).cast("string"),
            F.lit("    CUDA Version: 11."), (F.col("n") % 10).cast("string"), F.lit("     |")))
    )
    return n.select("source", text.alias("text"))
