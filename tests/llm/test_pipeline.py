"""The pipeline's stages against what their operators say of the same input."""

import corpus_pipeline
from tessera.llm import lines, minhash, mixing, quality
from tests.conftest import SF_SMALL
from tests.llm.helpers import got


def test_stages_on_the_small_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    tables = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1] if tables else docs, SF_SMALL).write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
    good, cut, single, mixed, packed = tables
    for t in tables[:-1]:
        assert t.columns == docs.columns
    ids = lambda t: sorted(r["doc_id"] for r in t.select("doc_id").collect())
    accepted = quality.classify(docs, labels).where("predicted = 1")
    assert ids(good) == ids(accepted)
    want = {r["doc_id"]: r["text"] for r in got(lines.dedup(good))}
    assert {r["doc_id"]: r["text"] for r in got(cut)} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got(cut))
    assert ids(single) == ids(minhash.near_duplicates(cut, words=5).where("kept"))
    takes = {r["doc"]["doc_id"]: len(r["draws"]) for r in got(mixing.mix(single))}
    assert ids(mixed) == sorted(i for i, n in takes.items() for _ in range(n))
    assert set(ids(packed)) == set(ids(mixed))
    whole = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == takes[r["doc_id"]] * r["max(doc_tokens)"] for r in whole)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    twice = docs.unionByName(docs)
    assert corpus_pipeline.distinct_documents(spark, twice, SF_SMALL).count() == \
        corpus_pipeline.distinct_documents(spark, docs, SF_SMALL).count()
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_SMALL).collect() == []
