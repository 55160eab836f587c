import hashlib
import re
from collections import Counter

import numpy as np

from tessera.llm import weighted
from tests.llm.helpers import documents, doc_rows, got, prose

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def jaccard(a, b):
    a, b = Counter(SPLIT.split(a)), Counter(SPLIT.split(b))
    return sum((a & b).values()) / sum((a | b).values())


def edit(text, after):
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def test_ring_of_documents(spark, monkeypatch):
    monkeypatch.setattr(weighted, "CHUNK_ROWS", 7)
    texts = {i * i: prose(i // 3, 20 + 5 * i) if i % 10 else "" for i in range(1, 60)}
    out = {r["doc_id"]: r for r in got(weighted.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")))}
    ids = sorted(texts)
    errors = []
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        r = out[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edit(text, after).encode()).hexdigest()
        errors += [r["near_edited"] - jaccard(text, edit(text, after)), r["near_next"] - jaccard(text, after)]
        if Counter(SPLIT.split(text)) == Counter(SPLIT.split(after)):
            assert r["fingerprint"] == out[ids[(k + 1) % len(ids)]]["fingerprint"] and r["near_next"] == 1.0
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.45


def test_collision_rate_is_generalised_jaccard(spark):
    a, b = ("u " * 9 + "v " * 3 + "w").strip(), ("u " * 3 + "v " * 6 + "x x").strip()
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    near = got(weighted.fingerprints(docs, samples=2048))[0]["near_next"]
    assert abs(near - jaccard(a, b)) < 0.05


def test_awkward_rows(spark):
    rows = doc_rows()
    out = got(weighted.fingerprints(documents(spark)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"]) for r in out) == sorted(
        (r[0] is None, r[0] or 0, len(r[1] or "")) for r in rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[60]["fingerprint"] == by_id[61]["fingerprint"]
    for r in out:
        if r["doc_id"] is None and r["n_chars"] == 0:
            assert r["edited_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_and_single(spark):
    assert weighted.fingerprints(documents(spark, [])).collect() == []
    one = got(weighted.fingerprints(spark.createDataFrame([(5, "a b c d")], "doc_id bigint, text string")))[0]
    assert one["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest() and one["near_next"] == 1.0
