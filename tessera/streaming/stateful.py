"""Streams that keep a state of their own per key.

The state lives in Spark's state store under the query's checkpoint, so a
restarted query goes on where the last one ended.
"""

from __future__ import annotations

import json
import math
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.numeric import percent
from tessera.functions.telemetry import parse_timestamp, to_number
from tessera.operators.telemetry import NUMERIC_FIELDS, monitor_fields

FIRST = "first_line bigint, first_us bigint, first_gpu_memory_total double, first_ram_total double"
FIRST_COLUMNS = ("first_us", "first_gpu_memory_total", "first_ram_total")


def _plain(value):
    """A pandas cell as a Python value, None where there is none."""
    return None if pd.isna(value) else value.item() if hasattr(value, "item") else value


def _first_sample(batches: Iterator[pd.DataFrame], held) -> tuple | None:
    """The state of a new series, of the sample with the lowest line number
    (None if no sample has a number); the chunks are written to ``held``."""
    first = None
    for x in batches:
        pickle.dump(x, held, pickle.HIGHEST_PROTOCOL)
        numbers = x["line_no"].dropna()
        if len(numbers) and (first is None or numbers.min() < first[0]):
            at = x.index.get_loc(numbers.idxmin())
            first = (int(numbers.min()), *(_plain(x[c].iat[at]) for c in ("us", "gpu_memory_total", "ram_total")))
    return first


def _chunks(held) -> Iterator[pd.DataFrame]:
    held.seek(0)
    while True:
        try:
            yield pickle.load(held)
        except EOFError:
            return


#: Bytes of a new series that a task holds in memory before they go to its temp folder.
HELD_BYTES = 8 << 20


def percent_series_stream(lines: DataFrame, delay: str = "1 hour", idle: str = "1 day") -> DataFrame:
    """W1 + W2 + H17 + H18 on a stream of monitor lines ``(source, line_no,
    line)``: what :func:`tessera.operators.telemetry.percent_series` gives.

    The state of a series ``(source, device)`` is its first sample: of the first
    micro-batch that has the device, the line with the lowest number.  A series
    that is silent for ``idle`` (event time, counted from its last sample and
    checked against the watermark, which trails by ``delay``) has ended; its
    state goes, and a later sample starts a new series.  Malformed lines are
    skipped; samples behind the watermark are late and dropped; a sample without
    a readable time keeps its series as it is.

    A device's samples of one micro-batch are handled by one task, Arrow batch by
    Arrow batch; those of a new series wait in a temporary file of the task until
    its first sample is known.  Samples without a line number are never the
    first; while a series has no numbered sample, what refers to it is null.
    """
    f = monitor_fields(lines, mode="skip")
    parsed = f.select("source", "line_no", "device", parse_timestamp("timestamp").alias("ts"),
                      *[to_number(c).alias(c) for c in NUMERIC_FIELDS])
    rows = parsed.withWatermark("ts", delay).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    kept = ["line_no", "us", *NUMERIC_FIELDS]
    silent = int(pd.Timedelta(idle).total_seconds() * 1000)
    columns = ["source", "device", *kept, *FIRST_COLUMNS]

    def with_first(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        batches = (x[kept].reset_index(drop=True) for x in batches)
        with tempfile.SpooledTemporaryFile(HELD_BYTES) as held:
            if not state.exists:
                found = _first_sample(batches, held)
                batches = _chunks(held)
                if found:
                    state.update(found)
            _, us, gpu, ram = state.get if state.exists else (None,) * 4
            last = None
            for x in batches:
                times = x["us"].dropna()
                if len(times):
                    last = int(times.max()) if last is None else max(last, int(times.max()))
                out = x.assign(source=key[0], device=key[1])
                out["first_us"] = pd.array([us] * len(x), dtype="Int64")
                out["first_gpu_memory_total"], out["first_ram_total"] = gpu, ram
                out["line_no"], out["us"] = out["line_no"].astype("Int64"), out["us"].astype("Int64")
                yield out[columns]
        if last is not None and state.exists:
            state.setTimeoutTimestamp(max(last // 1000 + silent, state.getCurrentWatermarkMs() + 1))

    schema = ("source string, device string, line_no bigint, us bigint, " + ", ".join(f"{c} double" for c in NUMERIC_FIELDS)
              + ", first_us bigint, first_gpu_memory_total double, first_ram_total double")
    x = rows.groupBy("source", "device").applyInPandasWithState(
        with_first, schema, FIRST, "append", GroupStateTimeout.EventTimeTimeout)
    gpu, ram = percent("gpu_memory_used", "gpu_memory_total"), percent("ram_used", "ram_total")
    x = x.select("source", "device", "line_no", F.timestamp_micros("us").alias("ts"),
                 ((F.col("us") - F.col("first_us")) / F.lit(1e6)).alias("seconds_since_start"), "gpu_utilization",
                 gpu.alias("gpu_memory_pct"), "cpu_utilization", ram.alias("ram_pct"),
                 "first_gpu_memory_total", "first_ram_total")
    return x.select("source", "device", "line_no", "ts", "seconds_since_start", "gpu_utilization", "gpu_memory_pct",
                    "cpu_utilization", "ram_pct",
                    ((F.col("gpu_memory_pct") / F.lit(100.0)) * F.col("first_gpu_memory_total")).alias("gpu_memory_mb"),
                    ((F.col("ram_pct") / F.lit(100.0)) * F.col("first_ram_total")).alias("ram_mb"))


class StopRule:
    """Early stopping of one run as its ranks report, epoch by epoch.

    An epoch is checked when all ranks have reported it and all epochs before it
    have been checked or skipped; until then its reports wait.  Its value is the
    mean over the ranks that have one; an epoch that none has is skipped.
    """

    def __init__(self, world_size: int, patience: int, said: str | None = None):
        self.world_size, self.patience = world_size, patience
        self.next, self.checks, self.improved, self.stopped = 0, 0, 0, False
        self.best: float | None = None
        self.best_epoch: int | None = None
        self.waiting: dict[str, dict[str, float | None]] = {}
        if said:
            vars(self).update(json.loads(said))

    def dump(self) -> str:
        return json.dumps({k: v for k, v in vars(self).items() if k not in ("world_size", "patience")})

    def report(self, epoch: int, rank: int, value: float | None) -> None:
        """A rank's value; of several for one epoch the first counts."""
        if epoch >= self.next:
            self.waiting.setdefault(str(epoch), {}).setdefault(str(rank), value)

    def checked(self) -> Iterator[tuple]:
        """The epochs that can be checked now: ``(epoch, value, improves,
        stops, best_epoch, best_value)``.  After the stop nothing improves."""
        while len(reports := self.waiting.get(str(self.next), {})) >= self.world_size:
            epoch, self.next = self.next, self.next + 1
            del self.waiting[str(epoch)]
            values = [reports[r] for r in sorted(reports, key=int) if reports[r] is not None]
            if not values:
                continue
            value = math.fsum(values) / len(values) if all(map(math.isfinite, values)) else sum(values) / len(values)
            improves = stops = False
            if not self.stopped:
                self.checks += 1
                improves = math.isfinite(value) and (self.best is None or value < self.best)
                if improves:
                    self.best, self.best_epoch, self.improved = value, epoch, self.checks
                stops = self.patience > 0 and (not math.isfinite(value) or self.checks - self.improved >= self.patience)
                self.stopped = stops
            yield epoch, value, improves, stops, self.best_epoch, self.best


STOP_SCHEMA = "epoch int, value double, improves boolean, stops boolean, best_epoch int, best_value double"


def early_stop_stream(reports: DataFrame, patience: int, world_size: int, run: str = "run_id") -> DataFrame:
    """W3 on the live feed of ``(run_id, epoch, rank, value)``, one report per
    rank and epoch in any order: a row per checked epoch, ``(run_id, epoch,
    value, improves, stops, best_epoch, best_value)``.

    The rule is that of :func:`tessera.operators.metrics.early_stop`; ``stops``
    is set once per run.  Epochs count from 0 without gaps; a rank without a
    value reports null.  The state of a run is its waiting reports and the best
    value so far: at most ``world_size`` numbers for each epoch that waits.
    """
    kind = reports.schema[run].dataType.simpleString()
    columns = [run, "epoch", "value", "improves", "stops", "best_epoch", "best_value"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rule = StopRule(world_size, patience, state.get[0] if state.exists else None)
        found = []
        for b in batches:
            for epoch, rank, value, known in zip(b["epoch"], b["rank"], b["value"], b["known"]):
                rule.report(int(epoch), int(rank), float(value) if known else None)
            found += [(key[0], *c) for c in rule.checked()]
        state.update((rule.dump(),))
        if found:
            yield pd.DataFrame(found, columns=columns).astype({"best_epoch": "Int64"})

    # a diverged loss is a value: it is told from a missing one before pandas sees both as NaN
    rows = reports.where(F.col("epoch").isNotNull() & F.col("rank").isNotNull()).select(
        run, "epoch", "rank", F.coalesce("value", F.lit(0.0)).alias("value"), F.col("value").isNotNull().alias("known"))
    return rows.groupBy(run).applyInPandasWithState(
        step, f"{run} {kind}, {STOP_SCHEMA}", "rule string", "append", GroupStateTimeout.NoTimeout)


def once(steps: DataFrame, keys: tuple = ("run_id", "rank", "epoch", "phase", "step"), ts: str = "ts",
         delay: str = "1 hour") -> DataFrame:
    """T2 for a feed that repeats rows (a client that resends after a lost
    acknowledgement): the first row of each key.  Keys are remembered until the
    watermark has passed their time; what comes later than that is late and is
    dropped by the windows anyway, so state stays bounded and no repeat counts."""
    return steps.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
