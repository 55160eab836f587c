"""H4 / U2 by dictionary against whole-text encoding with a real vocabulary."""

import random
from functools import partial

import numpy as np
import pytest

from tessera.operators import dictionary, udf

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = partial(dictionary.FileTokenizer, PATH)
SPECIAL = dictionary.special_strings(PATH)


def texts():
    r = random.Random(3)
    bits = ["the", " the", "word", " ", "  ", "\n", "\n\n", "\t", ".", ", ", "'s", "'ll", "don't", "42", " 3.14", "é", "naïve", "ß",
            "中文", "　", "\xa0", "😀", "é", "½", "!!", "<|endoftext|>", "\x1c", "\x85", "ſ", "αβγ", "д"]
    rows = ["", " ", "a", "the the the", "x" * 3000, "<|endoftext|>", "a <|endoftext|> b", " lead", "trail  "]
    rows += ["".join(r.choices(bits, k=r.randrange(1, 30))) for _ in range(300)]
    return list(enumerate(rows))


def test_dictionary_equals_whole_texts(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "row_id bigint, t string")
    plain = TOKENIZER()
    got = {r["row_id"]: r["input_ids"] for r in dictionary.encode_by_dictionary(df, "t", TOKENIZER, 5000, special=SPECIAL).collect()}
    assert got == {i: plain.encode(t) for i, t in rows}
    user = udf.encode_with_tokenizer(df, TOKENIZER, {"t": 8})
    want = {r["row_id"]: (r["t_input_ids"], r["t_attention_mask"]) for r in user.collect()}
    have = {r["row_id"]: (r["input_ids"], r["attention_mask"]) for r in dictionary.encode_by_dictionary(
        df, "t", TOKENIZER, 8, special=SPECIAL, pad_id=0).collect()}
    assert have == want


def test_end_id_and_rare_pieces(spark, monkeypatch):
    rows = texts()[:60]
    df = spark.createDataFrame(rows, "row_id bigint, t string")
    plain = TOKENIZER()
    for hot in (0.0, 1.0):  # all pieces by broadcast, none
        monkeypatch.setattr(dictionary, "HOT", hot)
        got = {r["row_id"]: r["input_ids"] for r in dictionary.encode_by_dictionary(
            df, "t", TOKENIZER, 6, special=SPECIAL, eos_id=50256).collect()}
        assert got == {i: plain.encode(t)[:5] + [50256] for i, t in rows}


def test_each_piece_is_encoded_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    class Counting(dictionary.FileTokenizer):
        def encode(self, text):
            with open(log, "a") as fh:
                fh.write(repr(text) + "\n")
            return super().encode(text)

    df = spark.createDataFrame([(i, "one two one two one") for i in range(200)], "row_id bigint, t string")
    out = dictionary.encode_by_dictionary(df, "t", partial(Counting, PATH), 100)
    assert out.count() == 200
    calls = open(log).read().split("\n")[:-1]
    assert sorted(calls) == sorted(set(calls)) == ["' one'", "' two'", "'one'"]


def test_null_text_fails_and_empty_table(spark):
    df = spark.createDataFrame([(1, None)], "row_id bigint, t string")
    with pytest.raises(Exception, match="a text is null"):
        dictionary.encode_by_dictionary(df, "t", TOKENIZER, 10).collect()
    assert dictionary.encode_by_dictionary(df.where("row_id > 1"), "t", TOKENIZER, 10).collect() == []


def test_decoding(spark):
    t = TOKENIZER()
    assert t.decode(np.array(t.encode("a  b\nc é"))) == "a  b\nc é"
