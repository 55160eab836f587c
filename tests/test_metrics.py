"""A2-A4, A10, W3, H15, H20-H22 against plain-Python restatements."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions.numeric import argmax, py_float_text, round_half_even
from tessera.operators import metrics as m


def py_early_stop(values, patience):
    """The stopping rule of a min-mode monitor with min_delta 0."""
    best, wait = math.inf, 0
    best_i = None
    for i, v in enumerate(values):
        if not math.isfinite(v):
            if patience > 0:          # patience 0: no callback at all
                return i, best_i
            continue
        if v < best:
            best, wait, best_i = v, 0, i
        else:
            wait += 1
            if patience > 0 and wait >= patience:
                return i, best_i
    return None, best_i


VALUES = st.lists(st.sampled_from([0.5, 0.4, 0.3, 0.45, 0.3, 0.2, 0.6, float("nan")]), min_size=1, max_size=8)


@settings(max_examples=20, deadline=None)
@given(st.lists(VALUES, min_size=1, max_size=6), st.integers(min_value=0, max_value=3))
def test_early_stop_equals_python(spark, runs, patience):
    data = [(r, e, v) for r, vals in enumerate(runs) for e, v in enumerate(vals)]
    df = spark.createDataFrame(data, "run_id long, epoch int, value double")
    got = {r.run_id: (r.stop_epoch, r.best_epoch) for r in m.early_stop(df, patience).collect()}
    for r, vals in enumerate(runs):
        assert got[r] == py_early_stop(vals, patience)


def test_round_half_even_equals_numpy(spark):
    xs = [0.12345, 0.12355, 2.5e-5, 1.00005, -0.00015, 0.3333333, 12.34565]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.y for r in df.select(round_half_even("x", 4).alias("y")).collect()]
    assert got == [float(np.round(x, 4)) for x in xs]


def test_checkpoint_number_text(spark):
    xs = [0.1234, 1.0, 12.5, 0.0001, 0.0, 3.1, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.s for r in df.select(py_float_text("x").alias("s")).collect()]
    assert got == [str(np.round(x, 4)) if x is not None else "None" for x in xs]


def test_checkpoint_names_carry_validation(spark):
    data = [(0, 0, 0, 0, "train", 0.5), (0, 0, 0, 0, "val", 0.25),
            (0, 0, 1, 0, "train", 0.4),                      # no validation in epoch 1
            (0, 1, 0, 0, "train", 0.7)]                      # rank 1 never validates
    df = spark.createDataFrame(data, "run_id long, rank int, epoch int, step long, phase string, loss double")
    got = {(r.rank, r.epoch): r.checkpoint for r in m.checkpoint_names(df, prefix="T5").collect()}
    assert got[(0, 0)] == "outputs/T5-epoch-0-train-loss-0.5-val-loss-0.25"
    assert got[(0, 1)] == "outputs/T5-epoch-1-train-loss-0.4-val-loss-0.25"
    assert got[(1, 0)] == "outputs/T5-epoch-0-train-loss-0.7-val-loss-None"
    last = m.checkpoint_names(df, max_epochs=2, save_only_last_epoch=True).collect()
    assert [(r.rank, r.epoch) for r in last] == [(0, 1)]


def test_argmax_ties_and_nan(spark):
    rows = [([1.0, 3.0, 3.0], 1), ([float("nan"), 5.0, float("nan")], 0), ([2.0], 0), ([0.0, -1.0], 1)]
    df = spark.createDataFrame(rows, "logits array<float>, label int")
    got = [r.a for r in df.select(argmax("logits").alias("a")).collect()]
    assert got == [int(np.argmax(np.array(x, dtype=np.float32))) for x, _ in rows]
    acc = m.argmax_accuracy(df).collect()[0]
    assert acc.n_examples == 4 and acc.n_correct == 3 and acc.accuracy == 0.75


def test_epoch_loss_and_cross_rank(spark):
    data = [(0, r, 0, s, "train", float(r + s)) for r in range(2) for s in range(10)]
    df = spark.createDataFrame(data, "run_id long, rank int, epoch int, step long, phase string, loss double")
    el = {r.rank: r.avg_loss for r in m.epoch_loss(df).collect()}
    assert el == {0: 4.5, 1: 5.5}
    x = m.loss_across_ranks(df, every_n=5).collect()
    steps = sorted((r.step, r.mean_loss) for r in x if r.level == "step")
    assert steps == [(4, 4.5), (9, 9.5)]
    assert [r.mean_loss for r in x if r.level == "epoch"] == [5.0]


def test_run_elapsed_text(spark):
    df = spark.createDataFrame([(0, "2024-01-01 00:00:00"), (0, "2024-01-01 01:30:30")], "run_id long, t string")
    df = df.select("run_id", F.to_timestamp("t").alias("ts"))
    r = m.run_elapsed(df).collect()[0]
    assert r.elapsed_sec == 5430.0 and r.elapsed_text == "90.50 min"
