"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its keys ``(term, step)``: a term
that occurs ``tf`` times gives one key for each of ``STEPS`` that ``tf``
reaches.  Signatures of similar documents are laid side by side in blocks and
stored by slices: slice ``i`` of a block is a bitmap over its documents that
says whose bit ``i`` is set.  The documents that may hold a key are the AND of
its ``HASHES`` slices; a filter never misses a key, so the bitmaps overestimate
term presence.

A query adds, for each of its terms, the weight times the most that the highest
step whose key may be there allows.  This sum over slices is an upper bound of
the score.  The ten highest bounds are scored exactly first; their tenth score
is a floor, and every document whose bound does not lie below it is scored
exactly from its text.  Nothing else can be in the answer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm.common import in_small_batches, runs, small, staged

#: Term frequencies that have a key of their own; between two steps a
#: frequency is overestimated by the next step less one.
STEPS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024, 4096, 16384)
HASHES = 3
#: Least bits of a signature for each key of the largest document of a block.
BITS = 10
#: Documents and bytes of a block at most (one document at least).
BLOCK_DOCS = 256
BLOCK_BYTES = 1 << 18
#: Terms that a task counts before it hands the counts on.
VOCABULARY = 300_000
#: Queries and their terms that are worked off together.
QUERIES = 1024
QUERY_TERMS = 200_000

#: Everything but ASCII letters and digits separates terms; A-Z is lower-cased.
#: In UTF-8 all other characters consist of bytes from 0x80 on.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

INDEX = "width int, docs array<bigint>, sizes array<bigint>, bits binary, term binary, n_docs bigint, n_terms bigint"


def terms(text: bytes | None) -> Counter:
    """The terms of a UTF-8 text with their frequencies."""
    return Counter((text or b"").translate(FOLD).split())


@lru_cache(maxsize=1 << 18)
def _hash(term: bytes) -> int:
    return int.from_bytes(blake2b(term, digest_size=8).digest(), "little")


def _mixed(x: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    """64 mixed bits of each (term hash, step)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(step, dtype=np.uint64) + np.uint64(1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _keys(counts: Counter) -> np.ndarray:
    """The keys of a document: one for each term and step that it reaches."""
    h = np.fromiter(map(_hash, counts), np.uint64, len(counts))
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    found = []
    for i, step in enumerate(STEPS):
        h = h[tf >= step]
        tf = tf[tf >= step]
        if not len(h):
            break
        found.append(_mixed(h, i))
    return np.concatenate(found)


def _slices(keys: np.ndarray, width: int) -> np.ndarray:
    """The slices of each key in a block of ``width`` (a power of two) slices."""
    a, b = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        at = a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)[None, :]
    return (at & np.uint64(width - 1)).astype(np.int64)


def _width(keys: int) -> int:
    return 1 << max(6, math.ceil(math.log2(BITS * keys)))


def _block(rows: list[tuple], width: int) -> dict:
    on = np.zeros((width, len(rows)), dtype=bool)
    for i, (_, _, keys) in enumerate(rows):
        on[_slices(keys, width).ravel(), i] = True
    return {"width": width, "docs": None if rows[0][0] is None else [r[0] for r in rows], "sizes": [r[1] for r in rows],
            "bits": np.packbits(on, axis=1).tobytes(), "term": None, "n_docs": len(rows), "n_terms": None}


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs (doc_id, text)`` in one pass over the texts.

    Two kinds of rows: blocks of signatures (``bits`` set; documents without an
    id have blocks of their own, whose ``docs`` is null), and counts: how many documents of a task hold a ``term``, and, where ``term`` and ``bits``
    are both null, its documents and terms in all.  Documents without a term
    (null, empty and blank texts among them) have no signature.  A task holds
    unfinished blocks of each width, so its memory does not grow with its
    input; a document as large as a block is a block of its own.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_blocks: dict[tuple[int, bool], list] = {}
        vocabulary: Counter = Counter()
        n_docs = n_terms = 0

        def counted() -> pd.DataFrame:
            rows = [{"term": t, "n_docs": c} for t, c in vocabulary.items()]
            rows.append({"term": None, "n_docs": n_docs, "n_terms": n_terms})
            return pd.DataFrame(rows).reindex(columns=columns).astype(object).where(lambda d: d.notna(), None)

        for batch in batches:
            ids, named, texts = batch["doc_id"].tolist(), batch["named"].tolist(), batch["text"].tolist()
            for lo, hi in runs([len(t or b"") for t in texts]):
                full = []
                for i in range(lo, hi):
                    counts = terms(texts[i])
                    if not counts:
                        continue
                    size = counts.total()
                    n_docs, n_terms = n_docs + 1, n_terms + size
                    vocabulary.update(counts.keys())
                    keys = _keys(counts)
                    width = _width(len(keys))
                    block = open_blocks.setdefault((width, named[i]), [])
                    block.append((ids[i] if named[i] else None, size, keys))
                    if len(block) >= min(BLOCK_DOCS, max(1, 8 * BLOCK_BYTES // width)):
                        full.append(_block(open_blocks.pop((width, named[i])), width))
                if full:
                    yield pd.DataFrame(full, columns=columns)
                if len(vocabulary) >= VOCABULARY:
                    yield counted()
                    vocabulary.clear()
                    n_docs = n_terms = 0
        for (width, _), block in sorted(open_blocks.items(), key=lambda x: x[0]):
            yield pd.DataFrame([_block(block, width)], columns=columns)
        yield counted()

    columns = [c.split(" ")[0] for c in INDEX.split(", ")]
    doc_id = F.col("doc_id").cast("bigint")
    texts = in_small_batches(docs).select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNotNull().alias("named"),
                                          F.col("text").cast("binary").alias("text"))
    return staged(texts.mapInPandas(work, INDEX), "signatures")


@dataclass
class Queries:
    """Queries against one corpus: distinct terms with their hashes and weights,
    and for each query the places of its terms with their repeats."""
    hashes: np.ndarray
    weights: np.ndarray
    place: dict[bytes, int]
    starts: np.ndarray
    used: np.ndarray
    repeats: np.ndarray
    n_docs: int
    n_terms: int

    def length_norm(self, size: int) -> int:
        return 100 - 75 + (75 * size * self.n_docs) // self.n_terms

    def scores(self, counts: Counter, asked: list[int]) -> list[int]:
        """Exact scores of a document for the queries at ``asked``."""
        m = 8 * self.length_norm(counts.total())
        worth: dict[int, int] = {}
        for t in counts.keys() & self.place.keys():
            i, tf = self.place[t], counts[t]
            worth[i] = int(self.weights[i]) * ((1_000_000_000 * tf) // (1000 * tf + m))
        out = []
        for q in asked:
            at = range(self.starts[q], self.starts[q + 1])
            out.append(sum(worth.get(int(self.used[k]), 0) * int(self.repeats[k]) for k in at))
        return out

    def bounds(self, width: int, sizes: np.ndarray, bits: bytes) -> np.ndarray:
        """Upper bounds of all queries (rows) for the documents of a block."""
        n = len(sizes)
        rows = np.frombuffer(bits, dtype=np.uint8).reshape(width, -1)
        m = np.array([8 * self.length_norm(int(s)) for s in sizes], dtype=np.int64)
        most = np.zeros((len(self.hashes), n), dtype=np.int64)
        alive = np.arange(len(self.hashes))
        here = np.full((len(alive), rows.shape[1]), 255, dtype=np.uint8)
        for i in range(len(STEPS)):
            here &= np.bitwise_and.reduce(rows[_slices(_mixed(self.hashes[alive], i), width)], axis=1)
            some = here.any(axis=1)
            alive, here = alive[some], here[some]
            if not len(alive):
                break
            tf = np.minimum(STEPS[i + 1] - 1, sizes) if i + 1 < len(STEPS) else sizes
            worth = np.array([(10 ** 9 * int(t)) // (1000 * int(t) + int(x)) for t, x in zip(tf, m)], dtype=np.int64)
            on = np.unpackbits(here, axis=1, count=n).astype(bool)
            most[alive] = np.where(on, worth[None, :], most[alive])
        most *= self.weights[:, None]
        out = np.zeros((len(self.starts) - 1, n), dtype=np.int64)
        lengths = np.diff(self.starts)
        asked = np.flatnonzero(lengths > 0)
        for lo in range(0, len(asked), 64):  # a few queries at a time: the gathered rows stay small
            part = asked[lo:lo + 64]
            at = np.concatenate([np.arange(self.starts[q], self.starts[q + 1]) for q in part])
            out[part] = np.add.reduceat(most[self.used[at]] * self.repeats[at, None],
                                        np.concatenate([[0], np.cumsum(lengths[part])[:-1]]), axis=0)
        return out


def _prepared(index: DataFrame, texts: list[bytes | None]) -> Queries | None:
    """Look the terms' document counts up; None if nothing can be found."""
    asked = [terms(t) for t in texts]
    known = sorted(set().union(*asked))
    spark = index.sparkSession
    total = index.where("bits is null and term is null").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    if not known or not total["n_docs"]:
        return None
    wanted = spark.createDataFrame([(bytearray(t),) for t in known], "term binary")
    found = index.where("bits is null and term is not null").join(small(wanted, len(known)), "term").groupBy("term").agg(
        F.sum("n_docs").alias("df"))
    df = {bytes(r["term"]): r["df"] for r in found.collect()}  # at most the terms of the queries
    known = [t for t in known if t in df]
    n = total["n_docs"]
    place = {t: i for i, t in enumerate(known)}
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in known]
    parts = [[(place[t], c) for t, c in sorted(a.items()) if t in place] for a in asked]
    flat = [x for p in parts for x in p]
    return Queries(np.array([_hash(t) for t in known], dtype=np.uint64), np.array(weights, dtype=np.int64), place,
                   np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64),
                   np.array([x[0] for x in flat], dtype=np.int64), np.array([x[1] for x in flat], dtype=np.int64),
                   n, total["n_terms"])


def _highest_bounds(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``(query, doc_id, bound)``: the ``k`` highest bounds of each query in each task."""
    def work(batches):
        best = [[] for _ in range(len(queries.starts) - 1)]
        for batch in batches:
            for width, docs, sizes, bits in zip(batch["width"], batch["docs"], batch["sizes"], batch["bits"]):
                bound = queries.bounds(int(width), np.asarray(sizes, dtype=np.int64), bits)
                for q in np.flatnonzero(bound.max(axis=1, initial=0) > 0):
                    row = bound[q]
                    for i in np.argsort(-row, kind="stable")[:k]:
                        if row[i] > 0:
                            best[q].append((int(row[i]), None if docs is None else int(docs[i])))
                    best[q] = sorted(best[q], key=lambda x: -x[0])[:k]
        flat = [(q, d, b) for q, rows in enumerate(best) for b, d in rows]
        yield pd.DataFrame(flat, columns=["query", "doc_id", "bound"]).astype({"doc_id": object})

    blocks = index.where("bits is not null").select("width", "docs", "sizes", "bits")
    each = blocks.mapInPandas(work, "query int, doc_id bigint, bound bigint")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("bound").desc(), F.col("doc_id")))
    return each.withColumn("nth", nth).where(F.col("nth") <= k).drop("nth")


def _not_excluded(index: DataFrame, queries: Queries, floors: np.ndarray, last: list[int | None]) -> DataFrame:
    """``(query, doc_id)`` of all documents whose bound is above the query's
    floor, or equal to it with an id that is not behind the floor's."""
    def work(batches):
        for batch in batches:
            found = []
            for width, docs, sizes, bits in zip(batch["width"], batch["docs"], batch["sizes"], batch["bits"]):
                bound = queries.bounds(int(width), np.asarray(sizes, dtype=np.int64), bits)
                ids = [None] * len(sizes) if docs is None else docs.tolist()
                for q, i in zip(*np.nonzero((bound >= floors[:, None]) & (bound > 0))):
                    behind = last[q] is not None and (ids[i] is None or ids[i] > last[q])
                    if bound[q, i] > floors[q] or not behind:
                        found.append((int(q), ids[i]))
            yield pd.DataFrame(found, columns=["query", "doc_id"]).astype({"doc_id": object})

    return index.where("bits is not null").select("width", "docs", "sizes", "bits").mapInPandas(
        work, "query int, doc_id bigint")


def _scored(docs: DataFrame, wanted: DataFrame, queries: Queries) -> DataFrame:
    """Exact ``(query, doc_id, score)`` above 0 of the wanted (query, doc_id)."""
    wanted = staged(wanted.distinct().groupBy("doc_id").agg(F.collect_list("query").alias("asked")), "wanted")
    wanted = small(wanted, wanted.count())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(wanted, F.col("id").eqNullSafe(F.col("doc_id"))).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text", "asked")

    def work(batches):
        for batch in batches:
            found = []
            for doc_id, named, text, asked in zip(batch["doc_id"], batch["named"], batch["text"], batch["asked"]):
                asked = asked.tolist()
                found += [(q, doc_id if named else None, s) for q, s in zip(asked, queries.scores(terms(text), asked)) if s > 0]
            yield pd.DataFrame(found, columns=["query", "doc_id", "score"]).astype({"doc_id": object})

    return in_small_batches(texts).mapInPandas(work, "query int, doc_id bigint, score bigint")


def _answers(index: DataFrame, docs: DataFrame, texts: list[bytes | None], k: int) -> DataFrame:
    """``(query, rank, doc_id, score)`` of one block of queries."""
    spark = index.sparkSession
    queries = _prepared(index, texts)
    if queries is None:
        return spark.createDataFrame([], "query int, rank int, doc_id bigint, score bigint")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    first = _scored(docs, _highest_bounds(index, queries, k).select("query", "doc_id"), queries)
    first = first.withColumn("rank", nth).where(F.col("rank") == k).collect()  # one row a query at most
    floors, last = np.zeros(len(texts), dtype=np.int64), [None] * len(texts)
    for r in first:
        floors[r["query"]], last[r["query"]] = r["score"], r["doc_id"]
    found = _scored(docs, _not_excluded(index, queries, floors, last), queries)
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def _blocks(items: DataFrame, key: str) -> Iterator[list[tuple]]:
    """The items in order, in blocks of a bounded number of queries and bytes."""
    block, size = [], 0
    for r in items.select(F.col(key).alias("key"), F.col("text").cast("binary").alias("text")).distinct().orderBy(
            "key", "text").toLocalIterator():
        text = None if r["text"] is None else bytes(r["text"])
        if block and (len(block) >= QUERIES or size + len(text or b"") > 8 * QUERY_TERMS):
            yield block
            block, size = [], 0
        block.append((r["key"], text))
        size += len(text or b"")
    if block:
        yield block


def search(index: DataFrame, docs: DataFrame, items: DataFrame, key: str = "item_id", k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``(key, rank, doc_id, score)``.

    ``index`` is :func:`build`'s of the same ``docs``.  Only documents with a
    score above 0 count; equal scores are ranked by ascending doc_id, a null id
    last.  Items without a term (null, empty) have no row, and an empty corpus
    none at all.  Repeated rows of one item are one query; different texts under
    one key are ranked each for itself.  Rows of ``docs`` that share a doc_id are
    ranked each for itself, under the same id.  Items are worked off in blocks
    of at most ``QUERIES``; other columns of both tables are not read.
    """
    spark: SparkSession = index.sparkSession
    kind = items.select(key).schema[0].dataType.simpleString()
    out = spark.createDataFrame([], f"{key} {kind}, rank int, doc_id bigint, score bigint")
    for n, block in enumerate(_blocks(items, key)):
        names = spark.createDataFrame([(i, b[0]) for i, b in enumerate(block)], f"query int, {key} {kind}")
        part = _answers(index, docs, [b[1] for b in block], k).join(F.broadcast(names), "query")
        out = out.unionByName(staged(part.select(key, "rank", "doc_id", "score"), f"answers-{n}"))
    return out


def rank_all(docs: DataFrame, items: DataFrame, key: str = "item_id", k: int = 10) -> DataFrame:
    """Index ``docs`` and rank them for all ``items``."""
    return search(build(docs), docs, items, key, k)
