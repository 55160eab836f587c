"""Whitening against numpy's eigendecomposition of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, component string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 7, "c") for i, v in vectors], SCHEMA)


def brute(vectors, wanted=32):
    """Exact integers and rational covariance, then numpy's eigh."""
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    size = max(set(lengths), key=lambda s: (lengths.count(s), s)) if lengths else 0
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in good if len(v) == size]
    n = len(good)
    total = [sum(x[j] for _, x in good) for j in range(size)]
    dev = [sum((n * x[j] - total[j]) ** 2 for j in range(size)) for _, x in good]
    cov = np.array([[float(Fraction(sum((n * x[a] - total[a]) * (n * x[b] - total[b]) for _, x in good), n ** 3))
                     for b in range(size)] for a in range(size)]).reshape(size, size)
    e, u = np.linalg.eigh(cov) if size else (np.zeros(0), np.zeros((0, 0)))
    order = [k for k in np.argsort(-e)[:wanted] if e[k] > 1e-11 * e.max()]
    centred = np.array([[float(Fraction(n * x[j] - total[j], n)) for j in range(size)] for _, x in good]).reshape(n, size)
    return [i for i, _ in good], n, dev, centred @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(cov) if order else e[:0]


def check(df, vectors, signs=True):
    ids, n, dev, white, explained = brute(vectors)
    rows = df.collect()
    assert len(rows) == len(ids) * len(explained)
    have = {}
    for r in rows:
        have.setdefault(r["vec_id"], []).append(r)
    for k in range(len(explained)):
        got = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in rows if r["component"] == k + 1)
        sign = 1
        if signs:
            at = int(np.abs(white[:, k]).argmax())
            own = [w for i, _, w in got if i == ids[at]]
            sign = 1 if min(abs(w - white[at, k]) for w in own) < 1e-6 else -1
            want = sorted((i, d, sign * w) for i, d, w in zip(ids, dev, white[:, k]))
            assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 for a, b in zip(got, want))
        assert all(abs(r["explained"] / explained[k] - 1) < 1e-8 for r in rows if r["component"] == k + 1)
    assert {r["n"] for r in rows} <= {n}
    errors = {r["identity_error"] for r in rows}
    assert len(errors) <= 1 and all(e < 1e-8 for e in errors)
    return rows


def random_vectors(n, size, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, size)) * np.linspace(3, 0.2, size) + rng.standard_normal(size)
    return [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]


def test_awkward_rows(spark):
    v = random_vectors(300, 6)
    v += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [math.nan] * 6), (404, [math.inf] + [0.0] * 5),
          (405, [1.0, 2.0]), (406, [0.0] * 7), (5, v[5][1]), (5, v[9][1])]
    rows = check(whitening.whiten(frame(spark, v)), v)
    assert whitening.whiten(frame(spark, v)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert {r["component"] for r in rows} == set(range(1, 7))
    more = whitening.whiten(frame(spark, v + [(None, v[0][1])])).where("vec_id is null").collect()
    assert len(more) == 6 and [r["whitened"] for r in more] == [
        r["whitened"] for r in whitening.whiten(frame(spark, v + [(None, v[0][1])])).where("vec_id = 0").collect()]


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 4])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_constant_and_equal_directions(spark):
    v = [(i, [float(i % 2), 1.0, float(i // 2 % 2), float(i // 2 % 2)]) for i in range(64)]  # rank two, of unequal variance
    check(whitening.whiten(frame(spark, v)), v)
    v = [(i, [float(i >> k & 1) for k in range(5)]) for i in range(32)]  # five equal eigenvalues
    rows = check(whitening.whiten(frame(spark, v)), v, signs=False)
    assert len(rows) == 32 * 5


def test_large_entries(spark):
    v = [(i, [float(2 ** (18 + i % 3)), float(i)]) for i in range(12)]
    check(whitening.whiten(frame(spark, v)), v)
    far = whitening.whiten(frame(spark, [(i, [3e38 * (-1) ** i, float(i % 5)]) for i in range(12)])).collect()
    assert far and all(r["deviation"] is None for r in far)  # beyond a long


def test_more_components_than_wanted(spark):
    v = random_vectors(400, 48)
    ids, _, _, white, _ = brute(v)
    rows = check(whitening.whiten(frame(spark, v)), v)
    assert len(rows) == 400 * 32
    again = whitening.whiten(frame(spark, v).repartition(7)).collect()
    rows, again = ({(r["vec_id"], r["component"]): r for r in rs} for rs in (rows, again))
    for k, r in rows.items():  # the same components, bit by bit, however the rows lie
        assert r["explained"] == again[k]["explained"] and abs(r["whitened"] - again[k]["whitened"]) < 1e-12


@pytest.mark.parametrize("seed", range(6))
def test_inertia_and_intervals(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 5, 17, 40, 64][seed]
    a = rng.standard_normal((n, n))
    sym = a + a.T
    for x in (-3.0, -0.1, 0.0, 0.7, 5.0):
        assert whitening.inertia(sym - x * np.eye(n)) == (np.linalg.eigvalsh(sym) > x).sum()
    assert whitening.inertia(np.zeros((n, n))) == 0
    cov = a.T @ a
    e = np.sort(np.linalg.eigvalsh(cov))[::-1]
    parts = whitening.intervals(cov, 32)
    assert [c for _, _, c in parts] == [int(((e > lo) & (e <= hi)).sum()) for lo, hi, _ in parts]
    assert sum(c for _, _, c in parts) >= min(32, n)
    found = [whitening.feast(cov, *p) for p in parts]
    values = np.sort(np.concatenate([f[0] for f in found]))[::-1]
    assert np.allclose(values[:32], e[:32][:len(values[:32])], rtol=0, atol=1e-12 * e[0])
    for w, x in found:
        assert np.abs(cov @ x - x * w).max() < 1e-11 * e[0]


def test_the_whole_table(spark):
    from tessera.llm.queries import QUERIES

    v = [(r["vec_id"], None if r["embedding"] is None else list(r["embedding"]))
         for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op11_feast_whitening"](spark, SF_SMALL), v)
