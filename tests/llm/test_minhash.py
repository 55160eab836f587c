import numpy as np

from tessera.llm import minhash
from tests.llm.helpers import doc_rows, documents, edited, got, prose


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def expected(rows, n, percent):
    """Smallest reachable doc_id per row index, by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    ids = [i for i, _ in rows]
    parent = {i: i for i in ids if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is not None and ids[b] is not None and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(ids[a]), find(ids[b])
                    parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for i, s in zip(ids, sets)]


def check(df, rows, n, percent=80):
    have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got(df)), key=repr)
    want = sorted(((i, k, c, i == c) for i, k, c in expected(rows, n, percent)), key=repr)
    assert have == want


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in doc_rows()]
    check(minhash.near_duplicates(documents(spark), words=4), rows, 4)


def test_large_near_group_without_a_common_centre(spark):
    base = prose(5, 150)
    rows = [(i, edited(base, i, i % 12)) for i in range(1, 160)]
    rows += [(200 + i, edited(rows[i][1], i, 2)) for i in range(0, 150, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(minhash.near_duplicates(docs, words=5), rows, 5)


def test_blocks_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = prose(6, 100)
    rows = [(i, edited(base, i, 3 + i % 7)) for i in range(80)]
    check(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=4), rows, 4)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []


def test_estimate_is_close_to_jaccard():
    import pandas as pd

    probe, rng = minhash.probe_order(288), np.random.default_rng(0)
    for share in (0.3, 0.6, 0.8, 0.95):
        errors = []
        for _ in range(20):
            u = rng.integers(0, 2**63, 1200).astype(np.uint64)
            cut = int(1200 * (1 - share) / 2)
            a, b = np.unique(u[: 1200 - cut]), np.unique(u[cut:])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = minhash.signatures([a, b], 288, probe)
            errors.append(minhash.estimate(pd.Series([s[0].tobytes()]), pd.Series([s[1].tobytes()]))[0] - true)
        assert abs(np.mean(errors)) < 0.03
