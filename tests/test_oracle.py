"""Every registered query against its DuckDB oracle (sf0.001 here; the
driver and tools/check_oracle.py use sf0.01)."""

import pytest

import __spark_entry__ as entry
from tessera.plans.oracle import ORACLE as OWN
from tests.conftest import SF_SMALL
from tests.helpers import norm

#: The library's own queries; those of the training-data subpackage have tests there.
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in OWN}
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}


def test_every_query_has_an_oracle():
    from tessera.plans.queries import QUERIES as own

    assert sorted(own) == sorted(OWN) == sorted(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    idx = [rel.columns.index(c) for c in sorted(df.columns)]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "line_no", "text"]
    assert df.count() > 0
