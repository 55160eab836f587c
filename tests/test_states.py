"""U5 by mergeable states."""

import math
import random

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from tessera.operators.states import Auc, metric_by_states


def auc(rows, grid=1024):
    pos = [math.floor(s * grid) for s, p in rows if s is not None and p is True]
    neg = [math.floor(s * grid) for s, p in rows if s is not None and p is False]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_per_key_with_null_keys(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice([None, round(r.gauss(0, 1), 2)]), r.choice([True, False, None]), i) for i in range(900)]
    rows += [("one", 0.5, True, 0), ("none", None, None, 0)]
    df = spark.createDataFrame(rows, "k string, s double, p boolean, auc int").repartition(7)
    got = {x["k"]: (x["auc"], x["n_positive"], x["n_negative"]) for x in metric_by_states(
        df, Auc("s", "p"), ["auc", "n_positive", "n_negative"], ["s", "p"], ["k"], fans=3).collect()}
    assert set(got) == {"a", "b", None, "one", "none"}
    for k, (value, n_pos, n_neg) in got.items():
        own = [(s, p) for kk, s, p, _ in rows if kk == k]
        want = auc(own)
        assert (value is None and want is None) or abs(value - want) < 1e-12
        assert n_pos == sum(s is not None and p is True for s, p in own) and n_neg == sum(s is not None and p is False for s, p in own)


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(0.1, True), (0.9, False), (0.9, True)], "s double, p boolean")
    assert metric_by_states(df, Auc("s", "p"), ["auc"], ["s", "p"]).collect()[0]["auc"] == 0.25
    assert [r["auc"] for r in metric_by_states(df.where("s > 5"), Auc("s", "p"), ["auc"], ["s", "p"]).collect()] == [None]


def test_rows_are_not_shuffled(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id / 100.0 as s", "id % 2 = 0 as p")
    plan = metric_by_states(df, Auc("s", "p"), ["auc"], ["s", "p"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("MapInPandas"):]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(-2, 2), st.booleans()), max_size=40), st.lists(st.integers(0, 40), max_size=5))
def test_any_tree_gives_the_same(rows, cuts):
    m = Auc("s", "p", grid=8)
    at = sorted([0, *[min(c, len(rows)) for c in cuts], len(rows)])
    states = [m.update(m.init(), pd.DataFrame(rows[a:b], columns=["s", "p"])) for a, b in zip(at, at[1:])]
    while len(states) > 1:
        states = [m.merge(states[0], states[1]), *states[2:]][::-1]
    got, want = m.finish(states[0])["auc"], auc(rows, 8)
    assert (got is None and want is None) or got == pytest.approx(want)


def test_variant_fields(spark):
    """S7 as VARIANT: records of unlike shapes, missing paths and unfit values."""
    from tessera.session import staging_path
    from tessera.sources import files

    rows = [("a", '{"error":null,"n":[1,2],"d":{"x":"y"}}'), ("b", '{"error":"bad"}'), ("c", "[3]"), ("d", "7"), ("e", None)]
    path = staging_path(spark, "variant")
    files.write_variant(spark.createDataFrame(rows, "host string, rec string"), path, "rec")
    got = files.read_variant(spark, path, {"error": ("$.error", "string"), "n": ("$.n[1]", "int"), "x": ("$.d.x", "string"),
                                           "odd": ("$.error", "int"), "top": ("$[0]", "int")}, keep=["host"])
    assert sorted(map(tuple, got.collect())) == [
        ("a", None, 2, "y", None, None), ("b", "bad", None, None, None, None), ("c", None, None, None, None, 3),
        ("d", None, None, None, None, None), ("e", None, None, None, None, None)]
