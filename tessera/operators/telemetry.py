"""Device telemetry over monitor logs.

Input: ``(source, line_no, line)``, one row per monitor line, each line
``device, timestamp, gpu %, gpu memory used, gpu memory total, cpu %, ram
used, ram total``.  Per-source work is either an aggregate (partial/final)
or a chunked carry (see :mod:`tessera.operators.ordered`); no step puts a
whole log into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.numeric import percent
from tessera.functions.telemetry import (
    MONITOR_FIELDS, cuda_version, drop_subseconds, driver_version, megabytes_text,
    parse_timestamp, percent_text, split_fields, to_number,
)
from tessera.functions.text import py_strip
from tessera.operators.ordered import carry

# fixed value: the error text of a banner without versions
UNEXPECTED_BANNER = "nvidia-smi output is unexpected"
N_FIELDS = len(MONITOR_FIELDS) + 1
HOST_FIELDS = ["cpu_utilization", "ram_used", "ram_total"]
NUMERIC_FIELDS = MONITOR_FIELDS[1:]


def monitor_fields(df: DataFrame, mode: str = "strict", source: str = "source",
                   line_no: str = "line_no", line: str = "line", chunk: int = 1 << 16) -> DataFrame:
    """Split monitor lines into their text fields (the form the profile
    keeps): ``(source, line_no, device, timestamp, gpu_utilization, ...)``,
    all strings, sub-seconds dropped from the timestamp.

    ``mode``:
      * ``strict``: P6 + P7, the first line without 8 fields ends the log
        of its source (later valid lines are lost, as in the original).
      * ``skip``: lines without 8 fields are dropped, the rest kept.
      * ``backfill``: W5, a five-field line (one device of a multi-device
        tick) takes the host fields of the next eight-field line of its
        source; lines of other lengths are dropped.
    """
    f = df.select(F.col(source).alias("source"), F.col(line_no).alias("line_no"),
                  split_fields(line).alias("_f"))
    n = F.size("_f")
    if mode == "strict":
        # the cut of a source goes to each of its chunks, so the log is joined
        # by (source, chunk) and a long log is spread over many tasks
        f = f.withColumn("_k", F.struct("source", F.floor(F.col("line_no") / F.lit(chunk)).alias("c")))
        cut = f.groupBy("_k").agg(F.min(F.when(n != N_FIELDS, F.col("line_no"))).alias("_cut"))
        cut = cut.select("_k", F.min("_cut").over(Window.partitionBy("_k.source")).alias("_cut"))
        f = f.join(cut, "_k").where(F.col("_cut").isNull() | (F.col("line_no") < F.col("_cut"))).drop("_k", "_cut")
        f = f.where(n == N_FIELDS)
    elif mode == "skip":
        f = f.where(n == N_FIELDS)
    elif mode == "backfill":
        f = f.where((n == N_FIELDS) | (n == N_FIELDS - 3))
        host = F.when(n == N_FIELDS, F.struct(*[F.col("_f")[5 + i].alias(h) for i, h in enumerate(HOST_FIELDS)]))
        f = carry(f, host, "_host", ["source"], "line_no", direction="backward", inclusive=True, chunk=chunk)
    else:
        raise ValueError("mode must be 'strict', 'skip' or 'backfill'")
    cols = [F.col("_f")[0].alias("device"), drop_subseconds(F.col("_f")[1]).alias("timestamp")]
    cols += [F.col("_f")[2 + i].alias(name) for i, name in enumerate(MONITOR_FIELDS[1:4])]
    if mode == "backfill":
        cols += [F.col("_host")[h].alias(h) for h in HOST_FIELDS]
    else:
        cols += [F.col("_f")[5 + i].alias(h) for i, h in enumerate(HOST_FIELDS)]
    return f.select("source", "line_no", *cols)


def parse_monitor(df: DataFrame, mode: str = "strict", strict_values: bool = False, **kw) -> DataFrame:
    """Typed long table ``(source, line_no, device, ts TIMESTAMP, six DOUBLE
    fields)`` (H13, H14, H16)."""
    t = monitor_fields(df, mode, **kw)
    return t.select(
        "source", "line_no", "device",
        parse_timestamp("timestamp", strict_values).alias("ts"),
        *[to_number(c, strict_values).alias(c) for c in NUMERIC_FIELDS])


def device_max(parsed: DataFrame, keys=("source", "device")) -> DataFrame:
    """A5: maximum GPU %, GPU memory, CPU % and RAM per device."""
    return parsed.groupBy(*keys).agg(
        F.max("gpu_utilization").alias("max_gpu"),
        F.max("gpu_memory_used").alias("max_gpu_memory"),
        F.max("cpu_utilization").alias("max_cpu"),
        F.max("ram_used").alias("max_ram"))


def device_report(parsed: DataFrame, keys=("source", "device")) -> DataFrame:
    """A5 + H19: the maximum-utilisation table with its text cells."""
    m = device_max(parsed, keys)
    return m.select(
        *keys, "max_gpu", "max_gpu_memory", "max_cpu", "max_ram",
        percent_text("max_gpu").alias("max_gpu_text"),
        megabytes_text("max_gpu_memory").alias("max_gpu_memory_text"),
        percent_text("max_cpu").alias("max_cpu_text"),
        megabytes_text("max_ram").alias("max_ram_text"))


def first_values(parsed: DataFrame, keys=("source", "device"), order: str = "line_no") -> DataFrame:
    """First value of each series in log order (not the minimum)."""
    return parsed.groupBy(*keys).agg(
        F.min_by("ts", order).alias("first_ts"),
        F.min_by("gpu_memory_total", order).alias("first_gpu_memory_total"),
        F.min_by("ram_total", order).alias("first_ram_total"))


def _with_firsts(parsed: DataFrame, keys: list[str], chunk: int = 1 << 16) -> DataFrame:
    """W1 on every sample: the first values of a chunk of lines, carried to all
    chunks of the series by a window over the small per-chunk table, and joined
    by (keys, chunk), so a long series is spread over many tasks."""
    x = parsed.withColumn("_k", F.struct(*keys, F.floor(F.col("line_no") / F.lit(chunk)).alias("_chunk")))
    first = F.struct(F.min("line_no").alias("l"), F.min_by("ts", "line_no").alias("ts"),
                     F.min_by("gpu_memory_total", "line_no").alias("gpu"), F.min_by("ram_total", "line_no").alias("ram"))
    per = x.groupBy("_k").agg(first.alias("_f"))
    per = per.select("_k", F.min_by("_f", "_f.l").over(Window.partitionBy(*[F.col("_k")[k] for k in keys])).alias("_f"))
    return x.join(per, "_k").select(
        *parsed.columns, F.col("_f.ts").alias("first_ts"), F.col("_f.gpu").alias("first_gpu_memory_total"),
        F.col("_f.ram").alias("first_ram_total"))


def percent_series(parsed: DataFrame, keys=("source", "device"), totals: bool = False) -> DataFrame:
    """H17 + H18 + W1 + W2: per sample the seconds since the device's first
    sample, memory and RAM as percentages, and the percentages back on the
    absolute axis (factor = the first total of the series).  With ``totals``
    these factors are returned too, as :func:`absolute_to_percent` needs them."""
    x = _with_firsts(parsed, list(keys))
    secs = (F.unix_micros(F.col("ts").cast("timestamp"))
            - F.unix_micros(F.col("first_ts").cast("timestamp"))) / F.lit(1e6)
    mem_pct = percent("gpu_memory_used", "gpu_memory_total")
    ram_pct = percent("ram_used", "ram_total")
    x = x.select(*keys, "line_no", "ts", secs.alias("seconds_since_start"), "gpu_utilization",
                 mem_pct.alias("gpu_memory_pct"), "cpu_utilization", ram_pct.alias("ram_pct"),
                 "first_gpu_memory_total", "first_ram_total")
    return x.select(
        *keys, "line_no", "ts", "seconds_since_start", "gpu_utilization", "gpu_memory_pct",
        "cpu_utilization", "ram_pct",
        ((F.col("gpu_memory_pct") / F.lit(100.0)) * F.col("first_gpu_memory_total")).alias("gpu_memory_mb"),
        ((F.col("ram_pct") / F.lit(100.0)) * F.col("first_ram_total")).alias("ram_mb"),
        *(["first_gpu_memory_total", "first_ram_total"] if totals else []))


def absolute_to_percent(v, factor):
    """H18, the true inverse of ``(x / 100) * factor``; a factor of 0 gives null."""
    return F.lit(100.0) * v / F.nullif(factor, F.lit(0.0))


def _field_of(name: str):
    return lambda x: x[name]


def profile_nested(fields: DataFrame, chunk: int = 4096) -> DataFrame:
    """A6 + A7: the profile as nested data, ``device -> field -> [values]``
    in log order, values kept as text.

    One row per ``(source, chunk)`` of ``chunk`` consecutive lines, so no
    collected list grows with the log; concatenating the chunks in order
    gives the whole series.  Output ``(source, chunk, profile MAP<STRING,
    STRUCT<timestamp ARRAY<STRING>, ...>>)``.
    """
    f = fields.withColumn("chunk", F.floor(F.col("line_no") / F.lit(chunk)).cast("bigint"))
    per_dev = f.groupBy("source", "chunk", "device").agg(
        F.array_sort(F.collect_list(F.struct("line_no", *MONITOR_FIELDS))).alias("_s"))
    series = F.struct(*[F.transform("_s", _field_of(c)).alias(c) for c in MONITOR_FIELDS])
    per_dev = per_dev.select("source", "chunk", "device", series.alias("_series"))
    return per_dev.groupBy("source", "chunk").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("device", "_series")))).alias("profile"))


def profile_json(nested: DataFrame) -> DataFrame:
    """S7 shape: the nested profile as JSON text."""
    return nested.select("source", "chunk", F.to_json("profile").alias("profile_json"))


def parse_inventory(lines: DataFrame, source: str = "source", line: str = "line") -> DataFrame:
    """S5 + A8: ``name, bus id, memory`` lines to ``(source, name, device_id,
    memory)`` plus the device count of the source.  Extra fields are
    ignored and missing ones are null, as a three-name zip treats them.  A
    source that lists no device has one row, of nulls and the count 0."""
    f = lines.select(F.col(source).alias("source"),
                     F.when(F.col(line) != "", F.split(F.col(line), ",", -1)).alias("_f"))
    inv = f.select(F.struct("source").alias("_k"), "source", F.col("_f").isNotNull().alias("_dev"),
                   *[py_strip(F.try_element_at(F.col("_f"), F.lit(i + 1))).alias(n)
                     for i, n in enumerate(("name", "device_id", "memory"))])
    counts = inv.groupBy("_k").agg(F.count(F.when(F.col("_dev"), F.lit(1))).alias("n_devices"))
    some = inv.where("_dev").join(counts, "_k").select("source", "name", "device_id", "memory", "n_devices")
    null = F.lit(None).cast("string")
    none = counts.where("n_devices = 0").select(
        "_k.source", null.alias("name"), null.alias("device_id"), null.alias("memory"), "n_devices")
    return some.unionByName(none)


def parse_versions(banners: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """S6 + H12: driver and CUDA versions from banner text; when either is
    missing the row carries the error text instead."""
    d = driver_version(text)
    c = cuda_version(text)
    ok = d.isNotNull() & c.isNotNull()
    return banners.select(
        F.col(source).alias("source"),
        F.when(ok, d).alias("driver_version"),
        F.when(ok, c).alias("cuda_version"),
        F.when(~ok, F.lit(UNEXPECTED_BANNER)).alias("error"))


def profile_record(versions: DataFrame, inventory: DataFrame, nested: DataFrame) -> DataFrame:
    """S7 + D13: the profile record as JSON, for every host that has a banner
    or a log.

    Without an error there is a record per ``(source, chunk)`` of ``error``
    (null), the two versions, the device inventory and the chunk's nested
    profile; a host without parsed lines has the one record of chunk 0 with an
    empty profile.  A host with an error has exactly one record (chunk 0), of
    ``error`` and the (null) versions, as the original profiler returns.
    ``versions``: :func:`parse_versions`; ``inventory``:
    :func:`parse_inventory`; ``nested``: :func:`profile_nested`.
    """
    device = F.struct("name", "device_id", "memory")
    devs = inventory.where("n_devices > 0").groupBy(F.struct("source").alias("_k")).agg(
        F.array_sort(F.collect_list(device)).alias("devices"))
    hosts = versions.withColumn("_k", F.struct("source")).join(devs, "_k", "left").drop("source")
    # every chunk meets its host in one join, whose payload side may be split if
    # a host is large; hosts without a log and failing hosts need no payload
    chunks = nested.withColumn("_k", F.struct("source")).drop("source")
    columns = ["_k", "chunk", "error", "cuda_version", "driver_version", "devices", "profile"]
    logged = chunks.join(hosts, "_k", "left").where("error is null").select(*columns)
    zero, nothing = F.lit(0).cast("bigint").alias("chunk"), F.create_map().cast(nested.schema["profile"].dataType).alias("profile")
    silent = hosts.where("error is null").join(chunks.select("_k"), "_k", "left_anti")
    failing = hosts.where("error is not null").distinct()
    x = logged
    for rest in (silent, failing):
        x = x.unionByName(rest.select("_k", zero, "error", "cuda_version", "driver_version", "devices", nothing))
    x = x.withColumn("source", F.col("_k.source"))
    keep_nulls = {"ignoreNullFields": "false"}
    full = F.struct("error", "cuda_version", "driver_version", "devices", "profile")
    short = F.struct("error", "cuda_version", "driver_version")
    record = F.when(F.col("error").isNull(), F.to_json(full, keep_nulls)).otherwise(F.to_json(short, keep_nulls))
    return x.select("source", "chunk", record.alias("record_json"))
