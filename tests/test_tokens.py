"""H4-H11 and H23 against a byte-level restatement in Python."""

import pytest
from hypothesis import given, settings, strategies as st

from tessera.functions.tokens import PRESETS, encode_text
from tessera.operators.encode import decode, encode_causal, encode_pairs
from tessera.plans.standins import ByteTokenizer

TEXT = st.text(alphabet=st.sampled_from(list("ab .,?'") + ["é", "中", "😀", "\n"]), max_size=20)


def py_encode(text, n, p):
    ids = [b + 3 for b in text.encode("utf-8")][: n - p.n_special]
    real = ([p.bos] if p.bos is not None else []) + ids + ([p.eos] if p.eos is not None else [])
    fill = n - len(real)
    if p.side == "right":
        full, mask = real + [p.pad] * fill, [1] * len(real) + [0] * fill
    else:
        full, mask = [p.pad] * fill + real, [0] * fill + [1] * len(real)
    if p.labels == "copy":
        labels = list(full)
    elif p.labels == "mask_zero":
        labels = [-100 if x == 0 else x for x in full]
    else:
        labels = [-100 if m == 0 else x for x, m in zip(full, mask)]
    return full, mask, labels


@pytest.mark.parametrize("preset", sorted(PRESETS))
@settings(max_examples=10, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=10), n=st.integers(min_value=2, max_value=12))
def test_encode_equals_python(spark, preset, texts, n):
    p = PRESETS[preset]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    enc = encode_text("t", n, p)
    got = {r.id: (r.i, r.m, r.l) for r in df.select("id", enc["input_ids"].alias("i"),
                                                      enc["attention_mask"].alias("m"),
                                                      enc["labels"].alias("l")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_encode(t, n, p)


def test_length_edges_and_multibyte_cut(spark):
    n = 6
    texts = ["abcd", "abcde", "abcdef", "ééé", "", "a😀"]     # L-2, L-1, L, cut in a 2- and 4-byte char
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "row_id long, source_text string, target_text string")
    out = {r.row_id: r for r in encode_pairs(df, source_max_length=n, target_max_length=n).collect()}
    for i, t in enumerate(texts):
        ids, mask, _ = py_encode(t, n, PRESETS["seq2seq"])
        assert out[i].source_text_input_ids == ids
        assert out[i].source_text_attention_mask == mask
        assert out[i].labels == [-100 if x == 0 else x for x in ids]
        assert len(ids) == n


def test_pad_equal_to_eos_keeps_mask_by_length(spark):
    df = spark.createDataFrame([(0, "ab")], "id long, text string")
    r = encode_causal(df, max_length=5, preset="causal_copy", keep=("id",)).collect()[0]
    assert r.input_ids == [100, 101, 1, 1, 1]
    assert r.attention_mask == [1, 1, 0, 0, 0]
    assert r.labels == r.input_ids


def test_null_text_policy(spark):
    df = spark.createDataFrame([(0, None), (1, "a")], "id long, text string")
    assert encode_causal(df, max_length=4, keep=("id",), on_null="drop").count() == 1
    with pytest.raises(Exception):
        encode_causal(df, max_length=4, keep=("id",), on_null="error").collect()


def test_causal_preset_requires_equal_lengths(spark):
    df = spark.createDataFrame([(0, "a", "b")], "row_id long, source_text string, target_text string")
    with pytest.raises(ValueError):
        encode_pairs(df, source_max_length=4, target_max_length=5, preset="causal_left")


@settings(max_examples=10, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=10))
def test_decode_equals_python(spark, texts):
    tok = ByteTokenizer()
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "row_id long, source_text string, target_text string")
    out = decode(encode_pairs(df, source_max_length=9, target_max_length=9), "source_text_input_ids", "d")
    got = {r.row_id: r.d for r in out.collect()}
    for i, t in enumerate(texts):
        ids = tok([t], max_length=9)["input_ids"][0]
        assert got[i] == tok.decode(ids)


def test_unknown_preset():
    with pytest.raises(ValueError):
        encode_text("t", 4, "nope")


def test_decode_keeps_specials_when_asked(spark):
    tok = ByteTokenizer()
    df = spark.createDataFrame([(0, "hé .", "x")], "row_id long, source_text string, target_text string")
    enc = encode_pairs(df, source_max_length=8, target_max_length=8)
    out = decode(enc, "source_text_input_ids", "d", skip_special=False, clean_spaces=False).collect()[0]
    ids = tok(["hé ."], max_length=8)["input_ids"][0]
    assert out.d == tok.decode(ids, skip_special_tokens=False, clean_up_tokenization_spaces=False)
    assert out.d == "hé .</s><pad><pad>"
