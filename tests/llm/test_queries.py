"""The registered queries: DuckDB where SQL can say it, brute force elsewhere."""

import pytest

from tessera.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_CHECK, SF_SMALL
from tests.helpers import norm


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    have = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLE[name])
    at = [rel.columns.index(c) for c in cols]
    assert have == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)


def test_near_duplicates_of_the_whole_table(spark):
    from tests.llm.test_minhash import check

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(QUERIES["op3_hyperminhash"](spark, SF_SMALL), rows, 4)


def test_vectors_of_the_whole_table(spark):
    from tessera.llm.neighbours import audit_recall
    from tests.llm.test_neighbours import brute

    vectors = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rs = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in vectors.collect()]
    result = QUERIES["op4_pruned_graph"](spark, SF_CHECK)
    have = {r["vec_id"]: r["n_links"] for r in result.collect()}
    want = {i: n for i, n, _ in brute(rs)}
    assert all(have[i] <= want[i] for i in want) and sum(have.values()) >= 0.9 * sum(want.values())
    found, there = audit_recall(vectors, result)
    assert found >= 0.9 * there


def test_pages_and_lines_of_the_whole_table(spark):
    from tessera.llm.extract import main_text
    from tests.llm.test_lines import expected

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = {r["page_id"]: r for r in QUERIES["op8_minimum_cut"](spark, SF_SMALL).collect()}
    assert {i: r["text"] for i, r in out.items()} == {i: main_text(h) for i, h in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) > 0 for r in out.values())
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {i: t for (i, _), t in expected(rows).items()}
    assert {r["doc_id"]: r["text"] for r in QUERIES["op9_line_chunks"](spark, SF_SMALL).collect()} == want
