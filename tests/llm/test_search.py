"""Ranked search against brute force over all documents."""

import math
import random
import re

import numpy as np
import pytest

from tessera.llm import search
from tests.llm.helpers import doc_rows, documents, edited, prose

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    """(item, rank, doc_id, score) by the contract's formula, document by document."""
    docs = [(r[0], cut(r[1])) for r in rows]
    docs = [(i, t) for i, t in docs if t]
    n_docs, n_terms = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc_id, t in docs:
            m, score = 25 + (75 * len(t) * n_docs) // n_terms, 0
            for x in cut(text):
                if x in df and (tf := t.count(x)):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10 ** 9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return out


def items(spark, rows):
    return spark.createDataFrame([(*r, "de", 3) for r in rows], "item_id bigint, text string, lang string, score int")


def ranked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=lambda x: x[:2])


def test_awkward_rows(spark):
    rows = doc_rows()
    rows += [(2 ** 60 + i, rows[0][1]) + rows[0][2:] for i in range(15)]  # ties over ids that no double holds
    asked = [(1, rows[3][1]), (2, rows[20][1] + " " + rows[20][1]), (3, None), (4, ""), (5, "  .,; \n"), (6, "nowhere atall"),
             (7, "W1 w2, W3-w4"), (8, "café naïve 中文 İ"), (9, prose(7, 2000)), (None, "w7 w8"), (1, rows[3][1])]
    got = search.rank_all(documents(spark, rows), items(spark, asked))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    have = sorted(((r["item_id"] or 0, r["rank"], r["doc_id"], r["score"]) for r in got.collect()), key=lambda x: x[:2])
    assert have == sorted(((i or 0, *r) for i, *r in brute(rows, asked[:-1])), key=lambda x: x[:2])


def test_empty_tables(spark):
    none = documents(spark, [])
    assert search.rank_all(none, items(spark, [(1, "a b")])).collect() == []
    assert search.rank_all(documents(spark, [(1, None, None, None, None, None, None, None, None)]), items(spark, [(1, "a")])).collect() == []
    assert search.rank_all(documents(spark), items(spark, [])).collect() == []


def test_query_blocks_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 3)
    rows = [(i, prose(i, 10 + i % 60)) + (None,) * 7 for i in range(600)]
    rows += [(1000 + i, edited(rows[7][1], i, 1 + i % 3)) + (None,) * 7 for i in range(40)]
    asked = [(i, prose(i, 12)) for i in range(7)] + [(7, rows[7][1])]
    assert ranked(search.rank_all(documents(spark, rows), items(spark, asked))) == brute(rows, asked)


@pytest.mark.parametrize("seed", range(3))
def test_bounds_never_fall_short(seed):
    r = random.Random(seed)
    texts = [" ".join(r.choices([f"t{i}" for i in range(60)], weights=[1 / (1 + i) for i in range(60)], k=r.choice([1, 5, 40, 3000])))
             for _ in range(64)]
    counts = [search.terms(t.encode()) for t in texts]
    keys = [search._keys(c) for c in counts]
    width = search._width(max(map(len, keys)))
    block = search._block([(i, c.total(), k) for i, (c, k) in enumerate(zip(counts, keys))], width)
    known = sorted({t for c in counts for t in c})
    q = search.Queries(np.array([search._hash(t) for t in known], dtype=np.uint64), np.arange(1, len(known) + 1),
                       {t: i for i, t in enumerate(known)}, np.array([0, len(known), len(known) + 5]),
                       np.array([*range(len(known)), *range(5)]), np.array([1] * len(known) + [3] * 5), 64, sum(c.total() for c in counts))
    bound = q.bounds(width, np.array(block["sizes"]), block["bits"])
    exact = np.array([q.scores(c, [0, 1]) for c in counts]).T
    assert (bound >= exact).all()
    short = np.array([c.total() <= 40 for c in counts])
    assert (bound[:, short] <= 1.3 * exact[:, short] + 2_000_000).mean() > 0.9  # and not by much


def test_few_documents_are_scored(spark):
    """The bounds exclude nearly all documents, or the index would be of no use."""
    rows = [(i, prose(i, 60)) + (None,) * 7 for i in range(800)]
    docs = documents(spark, rows)
    index = search.build(docs)
    queries = search._prepared(index, [rows[5][1].encode(), rows[9][1].encode()])
    want = brute(rows, [(0, rows[5][1]), (1, rows[9][1])])
    floors = np.array([[s for i, rank, _, s in want if i == q and rank == 10][0] for q in (0, 1)])
    last = [[d for i, rank, d, _ in want if i == q and rank == 10][0] for q in (0, 1)]
    assert 20 <= search._not_excluded(index, queries, floors, last).count() < 100
