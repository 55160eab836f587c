"""Exact means of doubles of any size."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from tessera.operators import exact, metrics


def means(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, x double")
    return {r["k"]: (r["mean"], r["n"]) for r in exact.exact_mean(df, ["k"], "x", **kw).collect()}


def brute(xs, places=4):
    return float(Fraction(round(sum(map(Fraction, xs)) / len(xs) * 10 ** places), 10 ** places))


def test_sizes_far_apart(spark):
    big, tiny = 1e300, 5e-324
    rows = [("cancel", x) for x in (big, 0.5, -big, 1.5, tiny)] + [("tiny", x) for x in (1e-300, 2e-300, -1e-300, tiny)]
    rows += [("big", x) for x in (big, big * (1 + 2 ** -52), 1e285)] + [("max", 1.7976931348623157e308)] * 3
    r = random.Random(0)
    rows += [("all", math.ldexp(r.uniform(-1, 1), r.randrange(-1070, 1020))) for _ in range(500)]
    rows += [("powers", s * 2.0 ** e) for e in range(-1074, 1024) for s in (1, -1)] + [("powers", 3.0)]
    r.shuffle(rows)
    own = {}
    for k, x in rows:
        own.setdefault(k, []).append(x)
    for places in (4, 320):
        got = means(spark, rows, places=places, noise=None)
        assert got == {k: (brute(xs, places), len(xs)) for k, xs in own.items()}
    assert own["cancel"] and means(spark, rows, noise=None)["cancel"] == (0.4, 5)


def test_same_bits_for_any_partitioning(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), math.ldexp(r.uniform(-1, 1), r.choice([-996, 0, 996]))) for _ in range(600)]
    want = means(spark, rows, places=300)
    for n in (1, 3, 11):
        df = spark.createDataFrame(rows, "k string, x double").repartition(n)
        assert {x["k"]: (x["mean"], x["n"]) for x in exact.exact_mean(df, ["k"], "x", places=300).collect()} == want


def test_special_values_and_nulls(spark):
    rows = [("nan", math.nan), ("nan", 1.0), ("up", math.inf), ("up", 1e308), ("down", -math.inf), ("both", math.inf),
            ("both", -math.inf), ("null", None), ("some", None), ("some", 3.0), (None, 2.0), (None, 4.0), ("zero", -0.0)]
    got = means(spark, rows)
    assert math.isnan(got.pop("nan")[0]) and math.isnan(got.pop("both")[0])
    assert got == {"up": (math.inf, 2), "down": (-math.inf, 1), "null": (None, 1), "some": (3.0, 2), None: (3.0, 2), "zero": (0.0, 1)}


def test_decimal_ties_round_to_even(spark):
    rows = [("a", 0.0001), ("a", 0.0002), ("b", 0.0003), ("b", 0.0002), ("c", 1e9 + 0.0001), ("c", 1e9 + 0.0002)]
    got = means(spark, rows)
    assert (got["a"][0], got["b"][0]) == (0.0002, 0.0002)
    losses = [(i % 7, 0, 0, "train", round(random.Random(i).uniform(0, 5), 2)) for i in range(4000)]
    df = spark.createDataFrame(losses, "run_id int, rank int, epoch int, phase string, loss double")
    keys = ["run_id", "rank", "epoch", "phase"]
    plain = sorted(map(tuple, metrics.epoch_loss(df).collect()))
    assert sorted(map(tuple, exact.exact_mean(df, keys, "loss", name="avg_loss", count="n_steps").collect())) == plain


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=20), st.integers(0, 2))
def test_bins_hold_the_sum(xs, off):
    """Any choice of bins within the spare bit gives the exact sum."""
    bins = {}
    for x in xs:
        k = (math.frexp(x)[1] - 1) // exact.WIDTH if x else 0
        m = Fraction(x) / Fraction(2) ** exact._unit_exponent(k)
        assert m.denominator == 1 and abs(m) < 2 ** 62
        bins[k] = bins.get(k, 0) + int(m)
    assert exact.mean_of_bins(bins, len(xs), 30, None) == pytest.approx(
        float(sum(map(Fraction, xs)) / len(xs)), rel=1e-12, abs=1e-29)
