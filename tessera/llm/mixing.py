"""Mixing sources to target weights by a splitting tree.

Every source's documents are hashed into blocks of about ``block_words`` words;
the hash makes the order of blocks, and of documents in them, a permutation.
A source's target fixes how many blocks the mix takes from it, exactly: whole
passes over all blocks and a last, partial one, whose final block is filled
document by document.  The blocks of all sources are then dealt to output
shards of equal size: a binary tree over the shards splits the vector of block
counts by multivariate hypergeometric draws, as if all blocks had been
shuffled together.  A source's permuted blocks go to the shards in that order,
so no two shards share a drawn block, and every shard is shuffled on its own.

The tree works on at most ``COHORTS`` counts (cohorts of sources); a second
draw within each cohort splits its counts by source, so nothing that grows
with the number of sources or shards passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import small, staged, word_count
from tessera.operators.ordered import positions

COHORTS = 1024
#: Prefix sums over a source's blocks run inside groups of so many blocks.
GROUP = 4096
SALTS = 32


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Add ``ix`` and ``weight`` to ``(source, ...)``: the rank by code point order
    of the source, null last, and the weights in turn."""
    ranked = positions(sources.withColumn("_null", F.col("source").isNull().cast("int")),
                       ["_null", "source"], name="ix").drop("_null")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("ix") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", turn)


def targets(sources: DataFrame, max_repeat: int) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``: shares of all words
    by weight, none above ``max_repeat`` times the source's size, the excess
    shared out again by weight.  The common level rises until no further source
    reaches its limit; every step is one aggregate of two numbers."""
    cap = F.col("source_size") * max_repeat
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap <= level * F.col("weight")
        fixed, weight = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        risen = (total - fixed) / weight if weight else level
        if risen <= level:
            break
        level = risen
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _before(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Add to ``(ix, block, ...)`` the sum of each value over the source's earlier blocks."""
    df = df.withColumn("_g", F.floor(F.col("block") / GROUP))
    sums = df.groupBy("ix", "_g").agg(*[F.sum(v).alias(v) for v in values.values()])
    w = Window.partitionBy("ix").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("ix", "_g", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_{n}") for n, v in values.items()])
    w = Window.partitionBy("ix", "_g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out = df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(n) for n, v in values.items()])
    out = out.join(sums, ["ix", "_g"])
    for n in values:
        out = out.withColumn(n, F.col(n) + F.col(f"_{n}"))
    return out.drop("_g", *[f"_{n}" for n in values])


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of a last block that bring its words closest to the budget,
    in hash order, passing over those that no longer fit."""
    left = float(rows["budget"].iloc[0])
    units = rows.groupby("h")["size"].sum().sort_index()  # repeated rows go together
    chosen, over = [], []
    for h, size in units.items():
        if size <= left:
            chosen.append(h)
            left -= size
        else:
            over.append((size, h))
    if over and abs(min(over)[0] - left) < left:
        chosen.append(min(over)[1])
    return pd.DataFrame({"ix": [rows["ix"].iloc[0]], "block": [rows["block"].iloc[0]], "chosen": [chosen]})


def _split(counts: np.ndarray, lo: int, hi: int, first: int, last: int, shards: int, blocks: int, seed: int):
    """Yield ``(shard, counts)`` of the shards in ``first..last`` below the node ``lo..hi``."""
    if hi - lo == 1:
        yield lo, counts
        return
    mid = (lo + hi) // 2
    room = blocks * mid // shards - blocks * lo // shards
    rng = np.random.default_rng([seed, lo, hi])
    left = rng.multivariate_hypergeometric(counts, room, method="marginals")
    if first < mid:
        yield from _split(left, lo, mid, first, last, shards, blocks, seed)
    if last > mid:
        yield from _split(counts - left, mid, hi, first, last, shards, blocks, seed)


def _deal(quotas: DataFrame, blocks: int, shard_blocks: int, seed: int) -> DataFrame:
    """Which shard gets which of a source's drawn blocks: ``(ix, j, shard)``."""
    spark = quotas.sparkSession
    if blocks >= 1_000_000_000:
        raise ValueError("the draws need fewer than 10^9 blocks: raise block_words")
    shards = max(1, -(-blocks // shard_blocks))
    quotas = quotas.withColumn("cohort", F.pmod(F.xxhash64("ix"), F.lit(COHORTS)))
    counts = np.zeros(COHORTS, np.int64)
    for r in quotas.groupBy("cohort").agg(F.sum("quota").alias("n")).collect():  # COHORTS rows at most
        counts[r["cohort"]] = r["n"]
    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def tree(batches):
        for b in batches:
            for t in b["id"]:
                first, last = shards * t // tasks, shards * (t + 1) // tasks
                for shard, n in _split(counts, 0, shards, first, last, shards, blocks, seed):
                    c = np.flatnonzero(n)
                    yield pd.DataFrame({"shard": shard, "cohort": c, "n": n[c]})

    def by_source(dealt: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("ix")
        left = own["quota"].to_numpy(np.int64).copy()
        given = np.zeros(len(left), np.int64)
        rng = np.random.default_rng([seed, int(own["cohort"].iloc[0])])
        out = []
        for shard, n in dealt.sort_values("shard")[["shard", "n"]].itertuples(index=False):
            take = rng.multivariate_hypergeometric(left, n, method="marginals") if len(left) > 1 else np.array([n])
            out += [(ix, shard, lo, k) for ix, lo, k in zip(own["ix"], given, take) if k]
            left, given = left - take, given + take
        return pd.DataFrame(out, columns=["ix", "shard", "lo", "n"])

    dealt = spark.range(0, tasks, numPartitions=tasks).mapInPandas(tree, "shard bigint, cohort bigint, n bigint")
    parts = dealt.groupBy("cohort").cogroup(quotas.where("quota > 0").groupBy("cohort")).applyInPandas(
        by_source, "ix bigint, shard bigint, lo bigint, n bigint")
    return parts.select("ix", "shard", F.explode(F.sequence("lo", F.col("lo") + F.col("n") - 1)).alias("j"))


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[float, ...] = (1.0, 2.0, 3.0),
        max_repeat: int = 3, block_words: int = 1 << 15, shard_blocks: int = 64, seed: int = 7) -> DataFrame:
    """Plan a mix of ``docs (doc_id, source, text, ...)`` in which every source
    has its target share of words.

    Returns one row per input row: ``doc`` (a struct of the row's own columns,
    so that their names cannot clash), ``size`` (words; ``size`` may give
    another measure), ``source_size``, ``target`` (of the source), ``draws`` (an
    array of ``(pass, shard)``, one for each time that the mix takes the
    document) and ``taken`` (words taken, repeats counted).

    A null source is a source of its own, last in order.  A null or empty text
    has size 0; it goes with its block and adds nothing.  Rows with equal
    doc_id, source and size (null ids included) share their fate.  A source of
    no words has target 0.  An empty table gives an empty result.  Reruns agree.
    """
    spark = docs.sparkSession
    size = word_count(F.col("text")) if size is None else size
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.col("source").alias("source"),
                       size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", "source", size).alias("h"))
    narrow = staged(base.select("source", "size", "h"), "mix-sizes")
    sources = staged(cycled_weights(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights),
                     "mix-sources")
    sources = targets(sources, max_repeat)
    passes = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)) + 1e-9)
    sources = staged(sources.select(
        "ix", "source", "source_size", "target", passes.alias("full"),
        F.greatest(F.lit(0.0), F.col("target") - passes * F.col("source_size")).alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).alias("n_blocks")), "mix-targets")
    n_sources = sources.count()

    def with_source(rows: DataFrame) -> DataFrame:
        side = sources.withColumnRenamed("source", "_source")
        same = F.col("source").eqNullSafe(F.col("_source"))
        if n_sources <= 50_000:
            rows = rows.join(small(side, n_sources), same, "inner")
        else:  # a hot source is dealt over salts
            side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            rows = rows.join(side, same & (F.pmod("h", F.lit(SALTS)) == F.col("_salt"))).drop("_salt")
        share = F.col("h").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
        return rows.drop("_source").withColumn("block", F.floor(share * F.col("n_blocks")))

    placed = with_source(narrow)
    facts = ["full", "rest"]
    blocks = placed.groupBy("ix", "block").agg(
        F.sum("size").alias("words"), F.lit(1).alias("one"), *[F.first(c).alias(c) for c in facts])
    blocks = staged(_before(blocks, {"start": "words", "order": "one"}), "mix-blocks")
    end = F.col("start") + F.col("words")
    blocks = blocks.withColumn("partial", (F.col("start") < F.col("rest")) & (F.col("rest") >= 0.5)).withColumn(
        "last", F.col("partial") & (end > F.col("rest")))

    # the last block of each partial pass, document by document
    ends = blocks.where("last").select("ix", "block", (F.col("rest") - F.col("start")).alias("budget"))
    chosen = (placed.where("size > 0").select("ix", "block", "h", "size").join(small(ends, n_sources), ["ix", "block"])
              .groupBy("ix", "block").applyInPandas(_fill, "ix bigint, block bigint, chosen array<bigint>"))
    blocks = staged(blocks.join(chosen, ["ix", "block"], "left"), "mix-quotas")

    per_source = blocks.groupBy("ix").agg(F.count(F.lit(1)).alias("nb"), F.sum(F.col("partial").cast("bigint")).alias("m"),
                                          F.first("full").alias("full"))
    quotas = staged(per_source.withColumn("quota", F.col("full") * F.col("nb") + F.col("m")), "mix-quotas")
    n_drawn = quotas.agg(F.sum("quota")).first()[0] or 0
    dealt = _deal(quotas, n_drawn, shard_blocks, seed)

    # a source's drawn blocks in order: pass after pass, each begun elsewhere
    turn = F.xxhash64(F.lit(seed), "ix", "pass")
    whole = F.col("pass") < F.col("full")
    drawn = (blocks.drop("full").join(small(quotas, n_sources), "ix")
             .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full"))))
             .where(whole | F.col("partial"))
             .withColumn("j", F.col("pass") * F.col("nb") + F.pmod(F.col("order") + F.pmod(turn, F.lit(1 << 30)),
                                                                 F.when(whole, F.col("nb")).otherwise(F.greatest("m", F.lit(1))))))
    draws = drawn.select("ix", "block", "pass", "j").join(dealt, ["ix", "j"]).groupBy("ix", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    plan = staged(blocks.select("ix", "block", "last", "chosen").join(draws, ["ix", "block"], "left"), "mix-plan")

    out = with_source(base).join(plan, ["ix", "block"], "left")
    kept = F.when(F.col("last") & (F.col("size") > 0) & ~F.coalesce(F.array_contains("chosen", F.col("h")), F.lit(False)),
                  F.filter("draws", lambda d: d["pass"] < F.col("full"))).otherwise(F.col("draws"))
    none = F.array().cast("array<struct<pass:bigint,shard:bigint>>")
    out = out.withColumn("draws", F.coalesce(kept, none))
    return out.select("doc", "size", "source_size", "target", "draws",
                      (F.col("size") * F.size("draws")).alias("taken"))


def drawn_documents(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: a row ``(doc, pass, shard, order)`` each time that a document
    is taken, shards together and shuffled on their own."""
    rows = mixed.select("doc", F.explode("draws").alias("d")).select(
        "doc", F.col("d.pass").alias("pass"), F.col("d.shard").alias("shard"))
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), "doc.doc_id", "pass", "shard"))
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "shard").sortWithinPartitions("shard", "order", "doc.doc_id")
