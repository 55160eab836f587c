"""H4 / U2 by dictionary: every distinct piece of text is encoded once.

A byte-level BPE cuts a text into words, numbers, punctuation and white space
and encodes each piece for itself, so the ids of a text are those of its pieces.
Pieces repeat: Spark cuts all texts (a built-in expression), keeps the distinct
pieces, has the tokenizer encode each of them once, and looks them up.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessera.session import staging_path

# fixed value: how the common byte-level pattern cuts a text
PIECES = (r"'(?:[sdmt]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
          r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+")
#: A piece that makes up more than this share of all pieces is hot; there are
#: fewer hot pieces than its inverse, whatever the data, so they are broadcast.
HOT = 1e-4


class FileTokenizer:
    """A vocabulary file with the calls that the user-function operators make
    (``functools.partial(FileTokenizer, path)`` is a factory of it).  ``pad_id``
    fills up; no special ids are added."""

    def __init__(self, path: str, pad_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.pad_id = Tokenizer.from_file(path), pad_id

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, texts, max_length, padding="max_length", truncation=True, add_special_tokens=True):
        ids = np.full((len(texts), max_length), self.pad_id, dtype=np.int32)
        mask = np.zeros((len(texts), max_length), dtype=np.int32)
        for i, t in enumerate(texts):
            own = self.encode(t)[:max_length]
            ids[i, : len(own)], mask[i, : len(own)] = own, 1
        return {"input_ids": ids, "attention_mask": mask}

    def decode(self, ids, skip_special_tokens=True, clean_up_tokenization_spaces=False):
        return self.tokenizer.decode(list(map(int, ids)), skip_special_tokens=skip_special_tokens)


def special_strings(path: str) -> tuple[str, ...]:
    """The special strings of a vocabulary file."""
    return tuple(t.content for t in FileTokenizer(path).tokenizer.get_added_tokens_decoder().values())


def cut(text: Column, special: list[str]) -> Column:
    """The pieces of a text; a text with a special string is one piece."""
    whole = F.lit(False)
    for s in special:
        whole = whole | F.contains(text, F.lit(s))
    return F.when(whole, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)))


def encode_by_dictionary(df: DataFrame, text: str, tokenizer_factory: Callable[[], object], max_length: int,
                         row_id: str = "row_id", special: tuple[str, ...] = (), eos_id: int | None = None,
                         pad_id: int | None = None) -> DataFrame:
    """``(row_id, input_ids, attention_mask)``: the first ``max_length`` ids of
    each text (one less, and ``eos_id``, if that is given), padded with
    ``pad_id`` if that is given.

    ``tokenizer_factory()`` is called once per task and must return a byte-level
    BPE of the common pattern with ``encode(text) -> ids``; its special strings
    are named in ``special``.  ``row_id`` must be unique and not null.  A null
    text fails; an empty one has no ids of its own.

    A piece gives one id at least, so a row has ``max_length`` pieces at most.
    Hot pieces (``HOT`` of all) meet their ids by a broadcast of fewer than
    ``1 / HOT`` rows, the others by a shuffle in which no key is large.
    Java's classes of characters decide the cuts; a tokenizer of another Unicode
    version may cut texts with the newest letters otherwise.
    """
    spark = df.sparkSession
    checked = F.when(F.col(text).isNull(), F.raise_error(F.lit("a text is null")).cast("string")).otherwise(F.col(text))
    rows = df.select(row_id, checked.alias("_t"))
    pieces = rows.select(row_id, F.posexplode(F.slice(cut(F.col("_t"), list(special)), 1, max_length)).alias("pos", "piece"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_factory()
        for b in batches:
            ids = [np.asarray(tokenizer.encode(p), dtype=np.int32)[:max_length] for p in b["piece"]]
            yield b.assign(ids=ids)

    at = staging_path(spark, "pieces")
    counted = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    counted.mapInPandas(encode, "piece string, n bigint, ids array<int>").write.parquet(at)
    known = spark.read.parquet(at)
    total = known.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(known.where(F.col("n") > HOT * total).select("piece", F.col("ids").alias("hot_ids")))
    rare = known.where(F.col("n") <= HOT * total).select("piece", "ids")
    found = pieces.join(hot, "piece", "left")
    ids = found.where("hot_ids is not null").select(row_id, "pos", F.col("hot_ids").alias("ids")).unionByName(
        found.where("hot_ids is null").select(row_id, "pos", "piece").join(rare, "piece").select(row_id, "pos", "ids"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "ids")))
    ids = ids.groupBy(row_id).agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("_ids"))
    room = max_length - (eos_id is not None)
    own = F.slice(F.coalesce("_ids", F.array().cast("array<int>")), 1, room)
    if eos_id is not None:
        own = F.concat(own, F.array(F.lit(eos_id)))
    out = rows.select(row_id).join(ids, row_id, "left").select(row_id, own.alias("input_ids"))
    mask = F.array_repeat(F.lit(1), F.size("input_ids"))
    if pad_id is None:
        return out.select(row_id, "input_ids", mask.alias("attention_mask"))
    gap = F.lit(max_length) - F.size("input_ids")
    return out.select(row_id, F.concat("input_ids", F.array_repeat(F.lit(pad_id), gap)).alias("input_ids"),
                      F.concat(mask, F.array_repeat(F.lit(0), gap)).alias("attention_mask"))
