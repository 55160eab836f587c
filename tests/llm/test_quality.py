import zlib

import numpy as np

from tessera.llm import quality
from tests.conftest import SF_CHECK
from tests.llm.helpers import documents, doc_rows, got

LABELS = "doc_id bigint, quality int, toxic int, x int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in got(quality.classify(docs, labels))}
    assert len(out) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for r in out.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [i for i in truth if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == truth[i] for i in held]) > 0.95
    good = [out[i]["score"] for i in held if truth[i] == 1]
    bad = [out[i]["score"] for i in held if truth[i] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_awkward_rows(spark):
    ids = [r[0] for r in doc_rows() if r[0] is not None]
    labels = [(i, int(i % 3 > 0), 0, 1) for i in ids] + [(None, 1, 0, 1), (1, None, 0, 1), (10 ** 9, 0, 0, 1)]
    labels = spark.createDataFrame(labels, LABELS)
    out = got(quality.classify(documents(spark), labels))
    assert len(out) == len(doc_rows()) and all(0 <= r["score"] <= 1 for r in out)
    empty = [r["score"] for r in out if r["doc_id"] in (60, 61)]
    assert empty[0] == empty[1]
    kept = quality.keep_good(documents(spark), labels)
    assert kept.columns == documents(spark).columns and kept.count() == sum(r["predicted"] for r in out)


def test_one_label_or_none(spark):
    none = spark.createDataFrame([], LABELS)
    good = spark.createDataFrame([(i, 1, 0, 1) for i in range(20)], LABELS)
    bad = spark.createDataFrame([(i, 0, 0, 1) for i in range(20)], LABELS)
    for labels, want in ((none, 1), (good, 1), (bad, 0)):
        assert {r["predicted"] for r in got(quality.classify(documents(spark), labels))} == {want}
    assert quality.classify(documents(spark, []), good).collect() == []
