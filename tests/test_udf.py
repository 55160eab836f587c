"""U1-U5 with a real tokenizer library and with stand-ins."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import udf

tokenizers = pytest.importorskip("tokenizers")

VOCAB = {"[PAD]": 0, "[UNK]": 1, "[EOS]": 2, "the": 3, "cat": 4, "sat": 5, "on": 6, "mat": 7}


class WordLevelTokenizer:
    """The common call convention around a ``tokenizers`` word-level model."""

    def __init__(self):
        from tokenizers import Tokenizer, models, pre_tokenizers, processors
        self.tok = Tokenizer(models.WordLevel(VOCAB, unk_token="[UNK]"))
        self.tok.pre_tokenizer = pre_tokenizers.Whitespace()
        self.tok.post_processor = processors.TemplateProcessing(single="$A [EOS]", special_tokens=[("[EOS]", 2)])

    def __call__(self, texts, max_length, padding="max_length", truncation=True, add_special_tokens=True):
        self.tok.enable_truncation(max_length)
        self.tok.enable_padding(length=max_length, pad_id=0, pad_token="[PAD]")
        enc = self.tok.encode_batch(texts, add_special_tokens=add_special_tokens)
        return {"input_ids": np.array([e.ids for e in enc]), "attention_mask": np.array([e.attention_mask for e in enc])}


def test_user_tokenizer_with_a_real_library(spark):
    texts = ["the cat sat", "the cat sat on the mat mat mat", "dog"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, text string")
    out = udf.encode_with_tokenizer(df, WordLevelTokenizer, {"text": 6}, labels={"text": "mask_pad"}).collect()
    got = {r.row_id: r for r in out}
    want = WordLevelTokenizer()(texts, max_length=6)
    for i in range(len(texts)):
        assert got[i].text_input_ids == want["input_ids"][i].tolist()
        assert got[i].text_attention_mask == want["attention_mask"][i].tolist()
        assert got[i].labels == [x if m else -100 for x, m in zip(want["input_ids"][i], want["attention_mask"][i])]
    assert got[0].text_input_ids == [3, 4, 5, 2, 0, 0]
    assert got[2].text_input_ids == [1, 2, 0, 0, 0, 0]


def test_factory_is_called_once_per_task(spark, tmp_path):
    marker = tmp_path / "calls"
    marker.mkdir()

    def factory():
        import os
        import uuid
        (marker / uuid.uuid4().hex).write_text(str(os.getpid()))
        return WordLevelTokenizer()

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.createDataFrame([(i, "the cat") for i in range(200)], "row_id long, text string").repartition(4)
        assert udf.encode_with_tokenizer(df, factory, {"text": 4}).count() == 200
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(list(marker.iterdir())) <= 4          # 20 batches, at most one factory call per task


def test_batch_mapper_may_change_row_count(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "")], "id long, text string")

    def words(b: pd.DataFrame) -> pd.DataFrame:
        rows = [(i, w) for i, t in zip(b["id"], b["text"]) for w in t.split()]
        return pd.DataFrame(rows, columns=["id", "word"]).astype({"id": "int64"})

    out = udf.map_batches(df, words, "id long, word string").collect()
    assert sorted((r.id, r.word) for r in out) == [(1, "a"), (1, "b"), (1, "c")]


def test_metric_callback_per_key(spark):
    df = spark.createDataFrame([(k, float(v)) for k in range(3) for v in range(10)], "k long, v double")
    out = udf.metric(df, lambda b: {"s": b["v"].sum(), "n": len(b)}, ["s", "n"],
                     lambda c: {"mean": c["s"] / c["n"]}, cols=["v"], keys=["k"]).collect()
    assert sorted((r.k, r.mean) for r in out) == [(0, 4.5), (1, 4.5), (2, 4.5)]
