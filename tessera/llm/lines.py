"""Line dedup by repeated runs of lines.

A run of ``LEAST_LINES`` lines and ``LEAST_WORDS`` words that occurs more than
once in the corpus is a passage, wherever it stands in a document; a line of
``LONG_WORDS`` words or more is one by itself.  Every line begins and ends a
shortest such run; the runs' hashes, grouped in Spark, tell which of them repeat.
Longer passages are unions of these runs, so a passage goes as a whole whatever
stands around it (but for blank lines at its edges).  Occurrences are compared
byte by byte with the first occurrence, and all but that one are removed: the
first occurrence of a line in the corpus always stays.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from tessera.llm.common import in_small_batches, small, staged, word_count

#: Runs of fewer lines or words are not removed.
LEAST_LINES, LEAST_WORDS = 2, 8
#: A line of so many words is a passage by itself.
LONG_WORDS = 40
#: Base of the rolling hash over line hashes, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def shortest_runs(sizes: list[int]) -> list[tuple[int, int]]:
    """``(first, end)`` of the shortest runs of lines that are a passage, from
    every line on and up to every line; ``sizes`` are the lines' words.  Runs of
    more than ``LEAST_LINES`` lines begin and end with a line that has words, so
    a line is in few of them however many blank ones there are."""
    n, total = len(sizes), [0, *accumulate(sizes)]
    found = {(i, i + 1) for i, words in enumerate(sizes) if words >= LONG_WORDS}
    end = 0
    for first in range(n):
        end = max(end, first + LEAST_LINES)
        while end <= n and total[end] - total[first] < LEAST_WORDS:
            end += 1
        if end > n:
            break
        if sizes[first] or end - first == LEAST_LINES:
            found.add((first, end))
    first = n
    for end in range(n, 0, -1):
        first = min(first, end - LEAST_LINES)
        while first >= 0 and total[end] - total[first] < LEAST_WORDS:
            first -= 1
        if first < 0:
            break
        if sizes[end - 1] or end - first == LEAST_LINES:
            found.add((first, end))
    return sorted(found)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)


def _run_hashes(text: bytes) -> list[int]:
    """Hashes of the runs of a text."""
    lines = text.split(b"\n")
    runs = np.array(shortest_runs([len(x.split()) for x in lines]), np.int64).reshape(-1, 2)
    if not len(runs):
        return []
    h = pd.util.hash_array(np.array(lines, dtype=object), categorize=False)
    n = len(lines)
    upto = np.r_[np.uint64(0), np.cumsum(h * _powers(BASE, n)[:n], dtype=np.uint64)]
    first, end = runs.T
    return ((upto[end] - upto[first]) * _powers(UNBASE, n)[first]).view(np.int64).tolist()


def _candidates(text: bytes) -> list[tuple[int, int, bytes]]:
    lines = text.split(b"\n")
    return [(first, end, b"\n".join(lines[first:end])) for first, end in shortest_runs([len(x.split()) for x in lines])]


def _rows(docs: DataFrame) -> DataFrame:
    """Rows of the table with text, their id and a hash that tells texts apart."""
    text = F.col("text").cast("binary")
    return docs.where("text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), text.alias("text"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``(doc_id, mark, spans)``: per document the line ranges to remove.

    The occurrence to keep is the one with the smallest (doc_id, mark, first
    line), null ids last."""
    def hashes(batches):
        for b in batches:
            found = [(d, m, h) for d, m, t in zip(b["doc_id"], b["mark"], b["text"]) for h in _run_hashes(t)]
            yield pd.DataFrame(found, columns=["doc_id", "mark", "hash"])

    occ = staged(_rows(docs).mapInPandas(hashes, "doc_id bigint, mark bigint, hash bigint"), "run-hashes")
    again = staged(occ.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "run-again")
    hit = occ.join(small(again, again.count(), 500_000), "hash", "left_semi").select("doc_id", "mark").distinct()
    hit = staged(hit, "run-docs")

    def bodies(batches):
        for b in batches:
            found = [(d, m, f, e, body) for d, m, t in zip(b["doc_id"], b["mark"], b["text"]) for f, e, body in _candidates(t)]
            yield pd.DataFrame(found, columns=["doc_id", "mark", "first", "end", "body"])

    n_hit = hit.count()
    side = hit.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"))
    rows = _rows(docs)
    rows = rows.join(small(side, n_hit, 500_000), rows["doc_id"].eqNullSafe(side["_d"]) & (rows["mark"] == side["_m"]),
                     "left_semi")
    found = rows.mapInPandas(bodies, "doc_id bigint, mark bigint, first int, end int, body binary")
    found = found.withColumn("hash", F.xxhash64("body"))
    found = staged(found, "run-bodies")
    place = F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "mark", "first")
    keep = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(place.alias("place"), "body")).alias("one"))
    keep = keep.where("n > 1").select("hash", F.col("one.place").alias("place"), F.col("one.body").alias("same"))
    # the byte comparison: another run of that hash stays
    gone = (found.withColumn("here", place).join(keep, "hash")
            .where((F.col("body") == F.col("same")) & (F.col("here") != F.col("place"))))
    return gone.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


@F.pandas_udf(BinaryType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the lines in ``spans``; null stays null."""
    out = []
    for t, ranges in zip(text, spans):
        if t is not None:
            gone = {i for s in ranges for i in range(s["first"], s["end"])}
            t = b"\n".join([x for i, x in enumerate(t.split(b"\n")) if i not in gone])
        out.append(t)
    return pd.Series(out, dtype=object)


def dedup(docs: DataFrame, counts: bool = False) -> DataFrame:
    """``docs (doc_id, text, ...)`` without repeated runs of lines.

    Returns the input's columns with ``text`` shortened and, with ``counts``,
    ``removed_lines`` and ``removed_words``.  Every row stays, also one whose
    text becomes empty; a null text stays null and an empty one empty; lines
    that stay are not changed.  The first occurrence by doc_id stays (null ids
    last); rows with equal doc_id and text are one document, of which every row
    is cut alike.  An empty table gives an empty result.
    """
    gone = staged(repeated_chunks(in_small_batches(docs)), "run-removal")
    n = gone.count()

    own = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("doc"), F.col("doc_id").cast("bigint").alias("_id"),
                       F.xxhash64("text").alias("_mark"))
    side = gone.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), "spans")
    rows = rows.join(small(side, n, 50_000), rows["_id"].eqNullSafe(side["_d"]) & (rows["_mark"] == side["_m"]), "left")
    # only texts that lose lines go to Python
    rows = rows.withColumn("cut", _without(F.when(F.col("spans").isNotNull(), F.col("doc.text").cast("binary")), "spans").cast("string"))
    text = F.coalesce("cut", F.col("doc.text"))
    kept = [(text if c == "text" else F.col("doc")[c]).alias(c) for c in own]
    if counts:
        changed = F.col("cut").isNotNull()
        numbers = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["end"] - 1)))
        fewer = F.when(changed, F.size(F.array_distinct(numbers))).otherwise(0)
        words = F.when(changed, word_count(F.col("doc.text")) - word_count(F.col("cut"))).otherwise(0)
        kept += [fewer.cast("bigint").alias("removed_lines"), words.cast("bigint").alias("removed_words")]
    return rows.select(*kept)
