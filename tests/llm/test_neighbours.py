import gc
import os
import time

import numpy as np
import pytest

from tessera.llm import neighbours
from tests.llm.helpers import got

SCHEMA = "vec_id bigint, embedding array<float>, label int, cls string, n int"


def rows(n=900, dims=16, labels=3, seed=0):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 and out:
            v = np.array(out[r.integers(len(out))][1]) + r.normal(0, 0.03, dims)
        else:
            v = r.normal(0, 1, dims)
        out.append((i, [float(x) for x in np.float32(v)], int(r.integers(labels)), "x", 1))
    out += [(n + i, out[5][1], out[5][2], "x", 1) for i in range(40)]
    m = n + 100
    out += [(m, None, 1, None, 1), (m + 1, [0.0] * dims, 1, "x", 1), (m + 2, [1.0] * (dims - 1) + [None], 1, "x", 1),
            (m + 3, [1.0] * (dims - 1) + [float("nan")], 1, "x", 1), (m + 4, [float("inf")] + [1.0] * (dims - 1), 1, "x", 1),
            (m + 5, out[5][1], None, "x", 1), (m + 6, [], 1, "x", 1), (None, out[5][1], out[5][2], "x", 1),
            (m + 7, [2 * x for x in out[5][1]], out[5][2], "x", 1), (m + 7, [2 * x for x in out[5][1]], out[5][2], "x", 1),
            (m + 8, [1.0, 2.0], 1, "x", 1), (m + 9, [2.0, 4.0], 1, "x", 1), (m + 10, [1e-30] * dims, 2, "x", 1),
            (m + 11, [1e30] * dims, 2, "x", 1)]
    return out


def brute(rs, threshold=0.98):
    n, parent = [0] * len(rs), {r[0]: r[0] for r in rs if r[0] is not None}

    def usable(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and None not in v and np.isfinite(v).all() and any(v)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.array(np.float32(r[1]), float) / np.linalg.norm(np.array(np.float32(r[1]), float)) if usable(r) else None for r in rs]
    for a in range(len(rs)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rs[a][2] == rs[b][2] and len(unit[a]) == len(unit[b]) \
                    and unit[a] @ unit[b] >= threshold:
                n[a], n[b] = n[a] + 1, n[b] + 1
                x, y = find(rs[a][0]), find(rs[b][0])
                parent[max(x, y)] = min(x, y)
    return [(r[0], k, None if r[0] is None else find(r[0])) for r, k in zip(rs, n)]


@pytest.mark.parametrize("shard", [neighbours.SHARD, 120])
def test_recall_and_no_false_link(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    rs = rows()
    vectors = spark.createDataFrame(rs, SCHEMA)
    result = neighbours.near_vectors(vectors)
    have = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got(result)), key=repr)
    want = sorted(brute(rs), key=repr)
    assert [h[0] for h in have] == [w[0] for w in want]
    found, there = sum(h[1] for h in have), sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want)) and found >= 0.9 * there > 1000
    if shard == neighbours.SHARD and found == there:
        assert have == want
    asked, true = neighbours.audit_recall(vectors, result)
    assert asked >= 0.9 * true > 0


def test_blocks_of_a_shard_that_cannot_be_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 20)
    monkeypatch.setattr(neighbours, "LEVELS", 1)
    monkeypatch.setattr(neighbours, "FANOUT", 2)
    r = np.random.default_rng(1)
    base = r.normal(0, 1, 16)
    rs = [(i, [float(x) for x in np.float32(base + r.normal(0, 0.01, 16))], 0, "x", 1) for i in range(150)]
    have = sorted((x["vec_id"], x["n_links"], x["component_id"]) for x in got(neighbours.near_vectors(spark.createDataFrame(rs, SCHEMA))))
    assert have == brute(rs)


def test_empty_table(spark):
    assert neighbours.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_few_links_are_lost_between_shards(spark):
    """One label far above SHARD; vectors in pairs just above the threshold."""
    n, r = 3000, np.random.default_rng(0)
    a, b = r.normal(size=(2, n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = r.uniform(0.9801, 0.985, (n, 1))
    x = np.float32(np.concatenate([a, c * a + np.sqrt(1 - c * c) * b]))
    rs = [(i, [float(v) for v in row], 0, "x", 1) for i, row in enumerate(x)]
    result = neighbours.near_vectors(spark.createDataFrame(rs, SCHEMA))
    assert 0.992 * 2 * n <= sum(h["n_links"] for h in got(result)) <= 2 * n


def _disk(spark):
    """Bytes of shuffle files and staged tables."""
    sc = spark.sparkContext
    local = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    roots = [*local, sc.getCheckpointDir().removeprefix("file:")]
    return sum(os.lstat(os.path.join(d, f)).st_size for r in roots for d, _, names in os.walk(r) for f in names)


def test_disk_stays_within_the_input(spark, tmp_path, monkeypatch):
    """Several levels of splitting, and all that the links need but the result."""
    monkeypatch.setattr(neighbours, "SHARD", 100)
    monkeypatch.setattr(neighbours, "FANOUT", 4)
    x = np.random.default_rng(2).normal(size=(4000, 64))
    rs = [(i, [float(v) for v in row], 0, "x", 1) for i, row in enumerate(np.float32(x))]
    spark.createDataFrame(rs, SCHEMA).write.parquet(str(tmp_path / "vectors"))
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before = _disk(spark)
    result = neighbours.near_vectors(spark.read.parquet(str(tmp_path / "vectors")))
    for _ in range(20):  # shuffle files go in the background
        if (left := _disk(spark) - before) < 2.5 * x.size * 4:
            break
        time.sleep(0.5)
    assert left < 2.5 * x.size * 4
    assert sum(h["n_links"] for h in got(result)) == 0


def test_a_vector_goes_to_three_shards_in_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 60)
    monkeypatch.setattr(neighbours, "FANOUT", 3)
    x = neighbours._unit(np.random.default_rng(3).normal(size=(1500, 16)))
    rs = [(i, 7 + i % 2, [float(v) for v in row]) for i, row in enumerate(x)]
    places = neighbours.cluster_shards(spark.createDataFrame(rs, "cls bigint, grp bigint, vec array<double>"))
    grp = np.arange(1500) % 2 + 7
    row, rank, shard = neighbours._shards_of(places, grp, x)
    assert max(places.cells[16].first) > 30 and set(places.blocks) <= {1}
    assert sorted(row[rank == 0]) == list(range(1500)) and rank.max() == neighbours.OVERLAP - 1
    assert len(set(zip(row, shard))) == len(row) and np.bincount(row).max() <= neighbours.OVERLAP
    assert not set(shard[grp[row] == 7]) & set(shard[grp[row] == 8])
    # a vector finds the same shards whatever it is asked together with
    for some in np.array_split(np.random.default_rng(4).permutation(1500), 40):
        r, k, s = neighbours._shards_of(places, grp[some], x[some])
        assert set(zip(some[r], k, s)) == {(a, b, c) for a, b, c in zip(row, rank, shard) if a in set(some)}


def test_graph_and_search_against_plain_loops():
    x = neighbours._unit(np.random.default_rng(5).normal(size=(120, 6)))
    d = np.sqrt(np.maximum(2 - 2 * (x @ x.T), 0)).astype(np.float32)
    want = np.zeros((120, 120), bool)
    for i in range(120):
        left = [j for j in np.argsort(d[i], kind="stable") if j != i]
        while left:
            p = left.pop(0)
            want[i, p] = want[p, i] = True
            left = [j for j in left if neighbours.ALPHA * d[p, j] > d[i, j]]
    near = neighbours.robust_pruned(x)
    assert (near == want).all() and not near.diagonal().any() and not near.all()
    queries = np.arange(0, 120, 2)
    pairs = neighbours.range_search(x, near, queries, 0.9)
    truth = {(q, j) for q in queries for j in range(120) if j != q and x[q] @ x[j] >= 0.9}
    assert set(map(tuple, pairs)) <= truth and len(pairs) >= 0.9 * len(truth) > 20
    assert len(neighbours.range_search(x, np.zeros_like(near), queries, 0.9)) < len(truth)
    assert not neighbours.robust_pruned(x[:1]).any()


def test_labels_in_waves(spark, monkeypatch):
    rs = rows(300)
    vectors = spark.createDataFrame(rs, SCHEMA)
    whole = sorted(map(repr, got(neighbours.near_vectors(vectors))))
    monkeypatch.setattr(neighbours, "WAVE", 90)
    assert sorted(map(repr, got(neighbours.near_vectors(vectors)))) == whole


def test_adjacency_as_bits():
    for n in (1, 2, 3, 50):
        near = np.random.default_rng(n).random((n, n)) < 0.4
        near = (near | near.T) & ~np.eye(n, dtype=bool)
        bits = neighbours._packed(near)
        assert len(bits) == -(-n * (n - 1) // 16) and (neighbours._unpacked(bits, n) == near).all()
