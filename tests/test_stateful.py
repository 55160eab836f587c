"""Streams with a state per key: first samples, early stopping, repeated rows."""

import math
import random
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.operators import metrics, telemetry
from tessera.session import staging_path
from tessera.streaming import stateful, streams
from tests.helpers import rows


def run(spark, folders, batch, schema, stream, mode="append"):
    """Add a batch to the input and let a new query of the stream work it off."""
    src, out, ck = folders
    spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
    streams.run_to_table(stream(spark.readStream.schema(schema).parquet(src)), out, ck, output_mode=mode)
    return spark.read.parquet(out).drop("batch_id")


@pytest.fixture
def folders(spark):
    return [staging_path(spark, f"stateful-{n}") for n in ("src", "out", "ck")]


def sample(host, n, day, minute, used=10, total=100):
    return (host, n, f"dev0, 2024/01/{day:02d} 00:{minute:02d}:00.5, 50, {used}, {total}, 20, 30, {total * 2}")


SERIES = ["source", "device", "line_no", "ts", "seconds_since_start", "gpu_memory_pct", "ram_pct", "gpu_memory_mb", "ram_mb"]


def test_first_sample_survives_restarts(spark, folders):
    stream = lambda s: stateful.percent_series_stream(s, "1 hour", "2 days")
    a = [sample("h0", i, 1, i, used=i, total=100 + i) for i in range(5)] + [("h0", 5, "broken"), sample("h1", 0, 1, 3)]
    b = [sample("h0", 6 + i, 1, 10 + i, used=i, total=200) for i in range(4)] + [sample("h2", 0, 1, 11)]
    a.reverse()  # the first sample is that of the lowest line, not the first to come
    run(spark, folders, a, streams.MONITOR_SCHEMA, stream)
    got = run(spark, folders, b, streams.MONITOR_SCHEMA, stream)
    want = telemetry.percent_series(telemetry.parse_monitor(spark.createDataFrame(a + b, streams.MONITOR_SCHEMA), mode="skip"))
    assert rows(got, SERIES) == rows(want, SERIES)


def test_a_silent_series_ends(spark, folders):
    stream = lambda s: stateful.percent_series_stream(s, "1 minute", "1 day")
    run(spark, folders, [sample("h0", 0, 1, 0), sample("h1", 0, 1, 0)], streams.MONITOR_SCHEMA, stream)
    run(spark, folders, [sample("h1", 1, 5, 0)], streams.MONITOR_SCHEMA, stream)  # h0 is silent; the watermark moves on
    run(spark, folders, [sample("h1", 2, 5, 1)], streams.MONITOR_SCHEMA, stream)
    got = run(spark, folders, [sample("h0", 1, 5, 2), sample("h0", 2, 5, 4)], streams.MONITOR_SCHEMA, stream)
    seconds = {r["line_no"]: r["seconds_since_start"] for r in got.where("source = 'h0'").collect()}
    assert seconds == {0: 0.0, 1: 0.0, 2: 120.0}  # a new series begins


def batch_series(spark, lines):
    return rows(telemetry.percent_series(telemetry.parse_monitor(spark.createDataFrame(lines, streams.MONITOR_SCHEMA), mode="skip")), SERIES)


@pytest.mark.parametrize("held", [0, 1 << 20])
def test_a_series_of_several_arrow_batches(spark, folders, monkeypatch, held):
    monkeypatch.setattr(stateful, "HELD_BYTES", held)  # 0: the file of a new series goes to disk at once
    stream = lambda s: stateful.percent_series_stream(s, "1 hour", "2 days")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        a = [sample(f"h{i % 2}", i, 1, i, used=i, total=100 + i) for i in range(50)]
        random.Random(3).shuffle(a)
        b = [sample(f"h{i % 3}", 50 + i, 1, 10 + i, used=i, total=200) for i in range(45)]
        run(spark, folders, a, streams.MONITOR_SCHEMA, stream)
        got = run(spark, folders, b, streams.MONITOR_SCHEMA, stream)
        assert rows(got, SERIES) == batch_series(spark, a + b)
    finally:
        spark.conf.set(key, before)


def test_samples_without_a_number_are_never_the_first(spark, folders):
    stream = lambda s: stateful.percent_series_stream(s, "1 hour", "2 days")
    lines = [sample("h0", None, 1, 0, total=50), sample("h0", 4, 1, 1), sample("h0", 3, 1, 2, total=80), sample("h1", None, 1, 0)]
    got = run(spark, folders, lines, streams.MONITOR_SCHEMA, stream)
    assert rows(got, SERIES) == batch_series(spark, lines)


def test_a_new_series_is_not_held_in_memory(tmp_path):
    import pandas as pd

    chunks = [pd.DataFrame({"line_no": [9 - i, 5], "us": [i, None], "gpu_memory_total": [1.0 * i, 0.0], "ram_total": [None, 0.0]}) for i in range(8)]
    with open(tmp_path / "held", "w+b") as held:
        assert stateful._first_sample(iter(chunks), held) == (2, 7, 7.0, None)
        for x, y in zip(chunks, stateful._chunks(held), strict=True):
            pd.testing.assert_frame_equal(x, y)


REPORTS = "run_id bigint, epoch int, rank int, value double"


def batch_answer(spark, reports):
    values = (spark.createDataFrame(reports, REPORTS).groupBy("run_id", "epoch").agg(F.avg("value").alias("value"))
              .where("value is not null"))
    return rows(metrics.early_stop(values, patience=2), ["run_id", "stop_epoch", "best_epoch", "best_value"])


def test_ranks_out_of_order_over_three_batches(spark, folders):
    r = random.Random(2)
    reports = [(run_id, e, k, r.choice([0.5, 1.0, 1.5, 2.0])) for run_id in range(6) for e in range(5) for k in range(3)]
    reports += [(6, e, k, math.nan if (e, k) == (2, 1) else 1.0 / (1 + e)) for e in range(5) for k in range(3)]
    reports += [(7, e, k, math.inf if (e, k) == (1, 0) else 1.0) for e in range(3) for k in range(3)]
    reports += [(8, e, k, None if k == 1 or e == 1 else 3.0 - e) for e in range(4) for k in range(3)]  # nulls, a whole epoch too
    r.shuffle(reports)
    third = len(reports) // 3
    stream = lambda s: stateful.early_stop_stream(s, 2, 3)
    for part in (reports[:third], reports[third:2 * third] + reports[:5], reports[2 * third:]):  # some reports twice
        got = run(spark, folders, part, REPORTS, stream)
    assert got.groupBy("run_id").agg(F.count(F.when(F.col("stops"), 1)).alias("n")).where("n > 1").count() == 0
    seen = got.groupBy("run_id").agg(F.max(F.when(F.col("stops"), F.col("epoch"))).alias("stop_epoch"),
                                     F.max_by("best_epoch", "epoch").alias("best_epoch"),
                                     F.round(F.max_by("best_value", "epoch"), 12).alias("best_value"))
    assert rows(seen, ["run_id", "stop_epoch", "best_epoch", "best_value"]) == batch_answer(spark, reports)


def test_an_epoch_waits_for_all_ranks(spark, folders):
    stream = lambda s: stateful.early_stop_stream(s, 1, 2)
    assert run(spark, folders, [(0, 0, 0, 1.0), (0, 1, 0, 2.0), (0, 1, 1, 2.0)], REPORTS, stream).count() == 0
    got = run(spark, folders, [(0, 0, 1, 1.0)], REPORTS, stream)
    assert rows(got, ["epoch", "value", "improves", "stops"]) == [(0, 1.0, True, False), (1, 2.0, False, True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.0, math.nan, math.inf])), min_size=3, max_size=3),
                max_size=7), st.randoms(use_true_random=False), st.integers(0, 3))
def test_rule_does_not_depend_on_the_order(values, r, patience):
    reports = [(e, k, v) for e, vs in enumerate(values) for k, v in enumerate(vs)]
    want = stateful.StopRule(3, patience)
    for x in reports:
        want.report(*x)
    whole = list(want.checked())
    r.shuffle(reports)
    said, got = None, []
    for x in reports:  # a state written and read again between any two reports
        rule = stateful.StopRule(3, patience, said)
        rule.report(*x)
        got += rule.checked()
        said = rule.dump()
    assert repr(got) == repr(whole)


def test_repeated_steps_count_once(spark, folders):
    day = lambda h, m: datetime(2024, 1, 1, h, m)
    first = [(0, k, 0, i, "train", float(k + 1), day(10, i)) for k in range(2) for i in range(4)]
    stream = lambda s: streams.step_loss_stream(s, "1 hour", "10 minutes", distinct=True)
    run(spark, folders, first + first[:3], streams.STEP_SCHEMA, stream, "update")
    again = [(*x[:5], 99.0, x[6]) for x in first] + [(0, 0, 0, 7, "train", 6.0, day(10, 30))]
    run(spark, folders, again, streams.STEP_SCHEMA, stream, "update")
    got = streams.latest(spark, folders[1], ["window_start", "window_end", "run_id", "phase", "epoch"]).collect()
    assert [(r["n"], r["mean_loss"]) for r in got] == [(9, round(18 / 9, 12))]
