"""Packing documents into training sequences along a space-filling curve.

Every text becomes a vector of hashed four-byte windows, a random projection
takes the vector to a few dimensions, and the Hilbert key of the projected
point is the sort key: neighbours on the curve are documents of similar words.  Range
partitions of (key, doc_id, text hash) hold consecutive stretches of the curve
(many equal texts share a key, so the id splits them too); each is tokenised
and cut into full sequences on its own.  What is left at the end of a stretch
goes into sequences of power-of-two lengths, so no padding is needed at all.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import give_back, in_small_batches, runs

DIMS, BITS, HASHED = 4, 8, 512
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates below
    ``2 ** bits`` (Skilling's transposed form, for all rows at once)."""
    x = points.astype(np.int64).copy()
    n, dims = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            hit = (x[:, i] & q) != 0
            t = (x[:, 0] ^ x[:, i]) & p
            x[:, 0] = np.where(hit, x[:, 0] ^ p, x[:, 0] ^ t)
            if i:
                x[:, i] = np.where(hit, x[:, i], x[:, i] ^ t)
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_keys(texts: list[bytes | None]) -> np.ndarray:
    """Hilbert keys of the projected vectors of hashed four-byte windows; a text
    of fewer bytes has the key of the origin."""
    turn = np.random.default_rng(11).standard_normal((HASHED, DIMS))
    cuts = np.array([NormalDist().inv_cdf(i / (1 << BITS)) for i in range(1, 1 << BITS)])
    v = np.zeros((len(texts), HASHED))
    for i, t in enumerate(texts):
        if t and len(t) >= 4:
            w = np.ndarray(len(t) - 3, "<u4", t, strides=(1,)) * np.uint32(2_654_435_761)
            v[i] = np.bincount(w >> np.uint32(23), minlength=HASHED)
    v = np.log1p(v)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return hilbert_key(np.searchsorted(cuts, v @ turn))


# fixed values: how a byte-level BPE with the common pattern cuts a text before it
# merges, written out for the characters on which all Unicode versions agree
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u4e00-\u9fa5"
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACE = " \t\n\r\x0b\x0c\x85\xa0"
_CUT = re.compile(f"'(?:[sdmt]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
                  f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_OTHER = re.compile("[^\\x00-\u024f\u2010-\u2027\u2030-\u205e\u4e00-\u9fa5]")


class _Words(dict):
    """Ids by word; those of a word that is not there are asked for."""

    def __init__(self, ask):
        super().__init__()
        self.ask = ask

    def __missing__(self, word: str) -> bytes:
        return self.ask(word)


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    A byte-level BPE cuts a text into words, numbers, punctuation and white
    space and encodes each of these for itself.  Words repeat a lot, so their ids
    are remembered (up to ``remember`` of them in two generations, so that those
    in use outlive the rest) and only new ones go to the tokenizer's model, which
    takes them as they are cut.  Texts with characters outside the classes above,
    or with one of the vocabulary's special strings, are encoded whole.
    """

    def __init__(self, path: str, remember: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the character of each byte: its own where that is printable, else the next from 256 on
        own, rest = set(ByteLevel.alphabet()), iter(range(256, 512))
        self._units = {b: chr(b if chr(b) in own else next(rest)) for b in range(256)}
        self.remember = remember
        self.known: dict[str, bytes] = _Words(self._learn)
        self.old: dict[str, bytes] = {}
        self._long: list[str] = []

    def _learn(self, word: str) -> bytes:
        """The ids of a word of the older generation or of a new one."""
        ids = self.old.get(word)
        if ids is None:
            units = word.encode().decode("latin-1").translate(self._units)
            ids = array("I", [t.id for t in self._model.tokenize(units)]).tobytes()
        self.known[word] = ids
        if len(word) > 64:
            self._long.append(word)
        return ids

    def _whole(self, text: str) -> bool:
        return not text.isascii() and _OTHER.search(text) is not None or any(s in text for s in self._special)

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.remember // 2:
            self.old, self.known = self.known, _Words(self._learn)
        find = self.known.__getitem__
        out = [self._encode(t) if self._whole(t) else b"".join(map(find, _CUT.findall(t))) for t in texts]
        for word in self._long:  # not worth the memory
            del self.known[word]
        self._long.clear()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker; its memory of segments outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(docs: DataFrame, tokenizer_path: str, length: int = 1024, end_id: int = 0) -> DataFrame:
    """Cut ``docs (doc_id, text, ...)`` into pieces packed along the curve.

    Returns one row per piece (see ``PIECES``): a document is its token ids and
    then ``end_id``; each of its ids lies in exactly one piece.  Sequences hold
    ``length`` ids (a power of two), or a smaller power of two at the end of a
    range partition, so none needs padding.  A null or empty text is the one id
    ``end_id``.  Repeated rows and rows of one or no doc_id are packed each for
    itself.  An empty table gives an empty result; other columns are not read.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")

    def keyed(batches):
        give_back()
        for b in batches:
            texts = list(b["text"])
            keys = [curve_keys(texts[lo : lo + 1024]) for lo in range(0, len(texts), 1024)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": b["text"],
                                "key": np.concatenate(keys) if keys else np.zeros(0, np.int64)})
        give_back()

    def cut(batches):
        give_back()
        encode = encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        seq, fill, open_ = part << 33, 0, []  # open_: pieces of the sequence not yet full

        def frame(rows):
            cols = list(zip(*rows)) or [()] * 7
            names = [c.split()[0] for c in PIECES.split(", ")]
            data = {n: pd.array(c, dtype="Int64") for n, c in zip(names, cols)}
            return pd.DataFrame(data)

        for b in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in b["text"]]
            docs_ = [None if pd.isna(d) else int(d) for d in b["doc_id"]]
            for lo, hi in runs([len(t) for t in texts]):
                done = []
                end = np.array([end_id], "<u4").tobytes()
                for doc, ids in zip(docs_[lo:hi], encode(texts[lo:hi])):
                    ids += end
                    total, start = len(ids) // 4, 0
                    while start < total:
                        n = min(total - start, length - fill)
                        open_.append((doc, ids[4 * start : 4 * (start + n)], start, n, total))
                        start, fill = start + n, fill + n
                        if fill == length:
                            at = 0
                            for d, x, s, k, tot in open_:
                                done.append((d, s, k, zlib.crc32(x), tot, seq, at))
                                at += k
                            seq, fill, open_ = seq + 1, 0, []
                yield frame(done)
        # the rest, by descending powers of two
        done, room, at = [], 0, 0
        for d, x, s, k, tot in open_:
            used = 0
            while used < k:
                if not room:
                    room, at = 1 << (fill.bit_length() - 1), 0
                    fill -= room
                n = min(k - used, room)
                done.append((d, s + used, n, zlib.crc32(x[4 * used : 4 * (used + n)]), tot, seq, at))
                used, at, room = used + n, at + n, room - n
                if not room:
                    seq += 1
        if done:
            yield frame(done)
        give_back()

    spark = docs.sparkSession
    rows = in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    rows = rows.mapInPandas(keyed, "doc_id bigint, text binary, key bigint")
    order = ["key", "doc_id", F.xxhash64("text")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInPandas(cut, PIECES)
