"""H1, H2, P4, P5 and A1 against plain-Python restatements."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions.text import PY_WHITESPACE, py_strip
from tessera.operators.corpus import split_lines
from tests.helpers import rows

ALPHABET = st.sampled_from(list("ab:：\n\r\t ") + list(PY_WHITESPACE) + ["é", "中", "​"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=25)


def py_lines_document(texts):
    out = []
    for doc_id, t in enumerate(texts):
        for i, x in enumerate(t.split("\n")):
            s = x.strip()
            if s and not s[-1] == ":":
                out.append((doc_id, i, s))
    return sorted(out, key=repr)


def py_lines_group(groups):
    out = []
    for g, texts in groups.items():
        flat = "".join(t for _, t in sorted(texts))
        for x in flat.split("\n"):
            s = x.strip()
            if s and not s[-1] == ":":
                out.append((g, s))
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_strip_equals_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = {r.id: r.s for r in df.select("id", py_strip("t").alias("s")).collect()}
    assert got == {i: t.strip() for i, t in enumerate(texts)}


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_document_scope_equals_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert rows(split_lines(df, scope="document"), ["doc_id", "line_no", "text"]) == py_lines_document(texts)


@settings(max_examples=15, deadline=None)
@given(TEXTS, st.integers(min_value=1, max_value=4), st.sampled_from([1, 2, 1 << 16]))
def test_group_scope_equals_python(spark, texts, n_groups, chunk):
    data = [(i, f"g{i % n_groups}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, grp string, text string")
    out = split_lines(df, scope="group", group_col="grp", order_col="doc_id", chunk=chunk)
    groups = {}
    for i, g, t in data:
        groups.setdefault(g, []).append((i, t))
    assert rows(out, ["grp", "text"]) == py_lines_group(groups)


def test_edge_lines(spark):
    texts = ["", "   ", ":", "a：", "x\r\ny", "\x85a\xa0", "head:\nbody", "a\n\n\nb", "  c :  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert rows(split_lines(df), ["doc_id", "line_no", "text"]) == py_lines_document(texts)


def test_group_scope_is_partition_invariant(spark):
    data = [(i, f"g{i % 3}", f"p{i}" + ("\n" if i % 4 == 0 else "")) for i in range(60)]
    base = spark.createDataFrame(data, "doc_id long, grp string, text string")
    results = []
    for n in (1, 3, 16):
        out = split_lines(base.repartition(n), scope="group", group_col="grp", order_col="doc_id", chunk=7)
        results.append(rows(out))
    assert results[0] == results[1] == results[2]


def test_null_text_fails_or_is_dropped(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")
    assert rows(split_lines(df, on_null="drop")) == [(2, 0, "a")]
    with pytest.raises(Exception, match="null value in column text"):
        split_lines(df).collect()


def test_group_scope_sparse_order(spark):
    data = [(i * 7919 + 13, f"g{i % 2}", f"p{i}" + ("\n" if i % 3 == 0 else "")) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, grp string, text string")
    a = split_lines(df, scope="group", group_col="grp", order_col="doc_id", chunk=4, dense_order=False)
    b = split_lines(df, scope="group", group_col="grp", order_col="doc_id", dense_order=True)
    assert rows(a) == rows(b)
