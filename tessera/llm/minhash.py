"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles.  Every shingle is hashed
once; the high part of the hash chooses one of ``registers`` buckets, and a
bucket keeps the smallest remainder in 16 bits: its count of leading zeros and
the ten bits behind the leading one.  Empty buckets borrow from the first
filled bucket of a fixed probe order, so short texts have full signatures.
Bands of compressed registers give candidate pairs; the collision-corrected
Jaccard estimate discards hopeless ones; the rest is confirmed on full sets.

Large groups never expand to all pairs.  Texts with equal sets are one class.
In every band bucket the members are first compared with one hub, the member
with most companions over all bands: the text that the copies were made from
rather than one of the copies.  Members that this has not joined to the
bucket's largest component are then compared with the members of other
components of their buckets: pairs inside one component cannot change the
result, so leaving them out loses no link.  A shingle that no other of these
documents has is in no intersection, so the counts of such shingles bound a
pair's similarity; what the bound rules out is not paired at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import components, in_small_batches, runs, small, staged

#: Bands and registers per band: a pair of similarity 0.8 shares no band with
#: probability (1 - 0.8 ** 6) ** 48 < 5e-7.
BANDS, ROWS = 48, 6
MANTISSA_BITS = 10
#: Members, and shingles, of a block in the comparison between components.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    for lo, hi in runs([len(t or b"") for t in texts]):
        split = [(t or b"").lower().split() for t in texts[lo:hi]]
        flat = np.empty(sum(map(len, split)), dtype=object)
        flat[:] = [w for s in split for w in s]
        h = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        poly = h.copy()
        if len(h) >= words:
            poly = h[: len(h) - words + 1].copy()
            for j in range(1, words):
                poly = poly * base + h[j : len(h) - words + 1 + j]
        poly = _mix(poly)
        at = 0
        for s in split:
            if len(s) >= words:
                yield np.unique(poly[at : at + len(s) - words + 1])
            elif s:
                one = np.full(1, len(s), np.uint64)
                for j in range(at, at + len(s)):
                    one = one * base + h[j : j + 1]
                yield _mix(one)
            else:
                yield np.zeros(0, np.uint64)
            at += len(s)


def probe_order(registers: int) -> np.ndarray:
    rng = np.random.default_rng(20_230)
    return np.stack([rng.permutation(registers) for _ in range(registers)]).astype(np.int32)


def signatures(sets: list[np.ndarray], registers: int, probe: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of each non-empty set, one uint16 row each."""
    k = np.uint64(registers)
    low = np.uint64(0xFFFFFFFF)
    regs = np.zeros((len(sets), registers), np.uint16)
    filled = np.zeros((len(sets), registers), bool)
    for d, u in enumerate(sets):
        if not len(u):
            continue
        bucket = ((u >> np.uint64(32)) * k + (((u & low) * k) >> np.uint64(32))) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rest = u[first] * k  # what lies behind the bucket, rising with the hash
        mant, exp = np.frexp(rest.astype(np.float64) + 1.0)
        zeros = np.clip(64 - exp, 0, 63).astype(np.uint16)
        tail = ((mant - 0.5) * (2 << MANTISSA_BITS)).astype(np.uint16)
        regs[d, bucket[first]] = (zeros << MANTISSA_BITS) | tail
        filled[d, bucket[first]] = True
    d, i = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    source, step = regs.copy(), 0
    while len(d):
        from_ = probe[i, step]
        ok = filled[d, from_]
        regs[d[ok], i[ok]] = source[d[ok], from_[ok]]
        d, i, step = d[~ok], i[~ok], step + 1
    return regs


def profile(docs: DataFrame, words: int, registers: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, sig)``; digest and sig are null for the empty set."""
    def work(batches):
        probe = probe_order(registers)
        for b in batches:
            done = 0
            ids, texts = b["doc_id"], list(b["text"])
            for lo, hi in runs([len(t or b"") for t in texts]):
                sets = list(shingle_sets(texts[lo:hi], words))
                regs = signatures(sets, registers, probe)
                yield pd.DataFrame({
                    "doc_id": ids.iloc[lo:hi].to_numpy(),
                    "n_shingles": [len(u) for u in sets],
                    "digest": [hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None for u in sets],
                    "sig": [r.tobytes() if len(u) else None for u, r in zip(sets, regs)],
                })
                done = hi
            assert done == len(texts)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInPandas(work, "doc_id bigint, n_shingles bigint, digest binary, sig binary")


def full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(doc_id, shingles)`` of the documents whose id is in ``ids``."""
    def work(batches):
        for b in batches:
            texts = list(b["text"])
            for lo, hi in runs([len(t or b"") for t in texts], 1 << 20):
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[lo:hi].to_numpy(),
                                    "shingles": [u.view(np.int64) for u in shingle_sets(texts[lo:hi], words)]})

    ids = small(ids, ids.count(), 1_000_000)
    return (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
            .join(ids, "doc_id", "left_semi").mapInPandas(work, "doc_id bigint, shingles array<bigint>"))


def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaccard estimate from two signatures, corrected for registers that agree
    by chance: two different minima share the leading zeros with probability
    near 1/3 and the mantissa with probability ``2 ** -MANTISSA_BITS``."""
    if not len(a):
        return pd.Series([], dtype="float64")
    x = np.frombuffer(b"".join(a), np.uint16).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), np.uint16).reshape(len(b), -1)
    chance = 2.0 ** -MANTISSA_BITS / 3
    return pd.Series(np.clip(((x == y).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0))


def _confirmed(pairs: DataFrame, sigs: DataFrame, docs: DataFrame, words: int, percent: int,
               registers: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the similarity."""
    est = F.pandas_udf(estimate, "double")
    pa = sigs.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    pb = sigs.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    lo, hi = F.least("na", "nb"), F.greatest("na", "nb")
    # six standard errors of the estimate below the threshold, from the number
    # of registers that sets of this size fill by themselves
    own = F.lit(float(registers)) * (1 - F.exp(-lo / F.lit(float(registers))))
    t = percent / 100
    floor = F.lit(t) - 6 * F.sqrt(F.lit(t * (1 - t)) / own)
    likely = (pairs.join(pa, "a").join(pb, "b").where(100 * lo >= percent * hi)
              .withColumn("est", est("sa", "sb")).where(F.col("est") >= floor)
              .select("a", "b").distinct())
    likely = staged(likely, "likely")
    ids = staged(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct(), "likely-ids")
    sets = staged(full_sets(docs, ids, words), "sets")
    xa = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa"))
    xb = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    union = F.size("xa") + F.size("xb") - both
    return likely.join(xa, "a").join(xb, "b").where(100 * both >= percent * union).select("a", "b")


def _mixed(at: DataFrame) -> DataFrame:
    """``(key, main)`` of the buckets with members of several components; ``main``
    is the component with most members."""
    sizes = at.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("members"))
    return sizes.groupBy("key").agg(
        F.max(F.struct("members", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")
    ).where("comps > 1").select("key", "main")


def _unique_counts(sets: DataFrame) -> DataFrame:
    """``(rep, u)``: how many shingles of a document none of the others has."""
    shingles = sets.select("doc_id", F.explode("shingles").alias("s"))
    alone = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("rep")).where("df = 1")
    return alone.groupBy("rep").agg(F.count(F.lit(1)).alias("u"))


def _links_between(at: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join different components of a bucket, from members
    ``(key, rep, n, comp, main)`` and their full sets.

    A bucket is cut into blocks of ``BLOCK`` members and every pair of blocks
    is one task's group, so no group grows with the bucket.  Inside a group a
    member outside the main component is compared with all members of other
    components at once; links within a component found so far are left out.
    """
    sizes = at.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK),
                                             F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    own = at.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "rep", "n", "comp", "main", "own",
                         F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    dealt = dealt.join(sets.withColumnRenamed("doc_id", "rep"), "rep")

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rep, comp = rows["rep"].to_numpy(), rows["comp"].to_numpy().copy()
        block, main = rows["own"].to_numpy(), rows["main"].iloc[0]
        lengths = np.array([len(x) for x in rows["shingles"]])
        _, flat = np.unique(np.concatenate(rows["shingles"].to_list()), return_inverse=True)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        across = rows["x"].iloc[0] != rows["y"].iloc[0]
        marked = np.zeros(flat.max() + 1, bool)
        out = []
        for i in np.flatnonzero(comp != main):
            mine = flat[starts[i] : starts[i] + lengths[i]]
            marked[mine] = True
            both = np.add.reduceat(marked[flat], starts)
            marked[mine] = False
            near = 100 * both >= percent * (lengths + lengths[i] - both)
            if across:
                near &= block != block[i]
            for j in np.flatnonzero(near & (comp != comp[i])):
                if comp[j] != comp[i]:
                    out.append((rep[i], rep[j]))
                    comp[comp == max(comp[i], comp[j])] = min(comp[i], comp[j])
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("key", "x", "y").applyInPandas(work, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Group documents ``(doc_id, text, ...)`` whose shingle sets have a Jaccard
    similarity of ``percent`` / 100 or more.

    Returns one row per input row: ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest doc_id reachable over links) and ``kept``
    (doc_id = component_id).  A null or empty text, or one of white space, has
    the empty set and links with nothing.  Rows that share a doc_id are one
    document; a row with a null doc_id links with nothing, has a null
    component_id and is kept.  An empty table gives an empty result; columns
    other than doc_id and text are not read.
    """
    registers = bands * rows
    docs = in_small_batches(docs)
    prof = staged(profile(docs, words, registers), "profiles")
    real = prof.where("doc_id is not null and digest is not null")
    classes = staged(real.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    sigs = classes.select("rep", "n", "sig")

    width = 2 * rows
    band = F.expr(f"transform(sequence(0, {bands - 1}), j -> xxhash64(j, substring(sig, j * {width} + 1, {width})))")
    keys = classes.select("rep", "n", F.explode(band).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(keys.join(shared, "key"), "members")
    degrees = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    hub = F.max(F.struct("degree", F.xxhash64("rep").alias("h"), "rep"))["rep"]
    hubs = members.join(degrees, "rep").groupBy("key").agg(hub.alias("hub"))

    stars = members.join(hubs, "key").where("rep <> hub").select(
        F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    links = staged(_confirmed(stars, sigs, docs, words, percent, registers), "links")
    comps = staged(components(links), "components")

    # buckets that still hold several components, without the members that
    # cannot be linked with anything there
    at = members.join(comps, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    at = staged(at.join(_mixed(at), "key"), "mixed").drop("main")
    ids = staged(at.select(F.col("rep").alias("doc_id")).distinct(), "mixed-ids")
    sets = staged(full_sets(docs, ids, words), "mixed-sets")
    at = at.join(_unique_counts(sets), "rep", "left").withColumn("c", F.col("n") - F.coalesce("u", F.lit(0)))
    least = at.groupBy("key").agg(F.min("n").alias("n_min"))
    room = F.col("n") + F.greatest("n_min", "c") - F.col("c")
    at = staged(at.join(least, "key").where(100 * F.col("c") >= percent * room).select("key", "rep", "n", "comp"), "mixed")
    more = _links_between(at.join(_mixed(at), "key"), sets, percent)

    edges = links.unionByName(more)
    again = staged(real.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"),
                   "repeated")
    if not again.isEmpty():  # rows that share a doc_id are one document
        same = real.join(again, "doc_id").join(classes.select("digest", "rep"), "digest")
        edges = edges.unionByName(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = components(edges)
    by_class = classes.join(final, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    out = prof.drop("sig").join(by_class, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.cast("bigint").alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
