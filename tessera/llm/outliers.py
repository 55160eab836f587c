"""Quality rules by robust multivariate outliers.

Each text gives counts and, from them, a vector of transformed statistics.  Per
language and source the minimum covariance determinant estimates where the bulk
of the vectors lies: the mean and covariance of those ``SHARE`` of the rows
whose covariance has the least determinant.  It is found by concentration steps
over all rows: take the rows of least Mahalanobis distance, estimate anew, until
the determinant falls no more.  A document far from its group's bulk is
rejected.  All groups step at once; a step is two aggregations that combine
before they shuffle, so a source that holds a third of all rows is no
bottleneck, and models stay rows of a table, however many groups there are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import in_small_batches, runs, small, staged

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Deleted from UTF-8 bytes, white space and continuation bytes leave one byte
#: for each code point in a word.
NOT_COUNTED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
#: Deleted from a word, these leave nothing if it holds no letter.
NO_LETTER = bytes(c for c in range(128) if not chr(c).isalpha())
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Statistics and the least spread that each is held to have: below that a
#: difference means nothing, even where most texts agree exactly.  All but the
#: first are square roots of shares.
SPREAD = {"word_length": 0.05, "top_word": 0.05, "echoes": 0.1, "no_letter": 0.1, "symbols": 0.05, "upper": 0.05, "marks": 0.05,
          "digits": 0.05, "dup_lines": 0.1, "repeats": 0.1}
NAMES = tuple(SPREAD)
P = len(NAMES)
#: A text of this many words is pulled half way to its group's median: the
#: statistics of short texts scatter more.
PRIOR_WORDS = 50
#: Fewer rows make no group: they are pooled by language, then altogether.
LEAST_ROWS = 100
#: Share of a group's rows in the determinant, and starts of the search.
SHARE = 0.75
STARTS = ("tanh", "signs", "norm")
STEPS = 40
#: A clean normal vector is rejected with this probability.
ALPHA = 1e-4


def counts(text: bytes | None) -> tuple[list[int], list[float]]:
    """The contract's five counts of a text and its statistics."""
    t = text or b""
    words = t.split()
    n, chars = len(words), len(t.translate(None, NOT_COUNTED))
    symbols = len(t) - len(t.translate(None, SYMBOLS))
    lines = [x for x in t.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    repeat = repeated(ids)
    uses = np.bincount(ids, minlength=1)
    bare = sum(int(uses[i]) for w, i in index.items() if not w.translate(None, NO_LETTER))
    share = lambda k, of: math.sqrt(k / of) if of else 0.0
    deleted = lambda what: len(t) - len(t.translate(None, what))
    return [n, chars, symbols, dup, repeat], [
        math.log(chars / n) if n else 0.0, share(int(uses.max()), n),
        share(int((ids[1:] == ids[:-1]).sum()), n), share(bare, n), share(symbols, chars),
        share(deleted(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), share(deleted(b".,;:!?"), chars),
        share(deleted(b"0123456789"), chars), share(dup, len(lines)), share(repeat, n)]


def repeated(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many places lie in windows of ``window`` ids (a power of two) that
    occur twice or more.  Windows are named exactly, by doubling: the number of
    a window is that of the pair of its halves."""
    n, width, code = len(ids), 1, ids
    while width < window:
        if len(code) <= width:
            return 0
        pairs = code[:-width] * (int(code.max()) + 1) + code[width:]
        names, code, seen = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(names) == len(pairs):
            return 0
        width *= 2
    cover = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(seen[code] > 1)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover)[:n] > 0).sum())


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts and the statistics of each row."""
    def work(batches):
        for b in batches:
            t = b["text"].tolist()
            for lo, hi in runs([len(x or b"") for x in t]):
                found = [counts(x) for x in t[lo:hi]]
                out = b[["doc_id", "named", "lang", "source"]].iloc[lo:hi].reset_index(drop=True)
                yield pd.concat([out, pd.DataFrame([f[0] for f in found], columns=COUNTS),
                                 pd.DataFrame([f[1] for f in found], columns=NAMES)], axis=1)

    doc_id = F.col("doc_id").cast("bigint")
    texts = in_small_batches(docs).select(
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNotNull().alias("named"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("text").cast("binary").alias("text"))
    out = texts.mapInPandas(work, "doc_id bigint, named boolean, lang string, source string, "
                            + ", ".join(f"{c} bigint" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in NAMES))
    return out.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named")


def _grouped(rows: DataFrame) -> DataFrame:
    """Add ``grp``: the language and source, or a pool of small ones; the last
    pool is no group (null) if it is small itself."""
    sizes = rows.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    sizes = staged(sizes, "group-sizes")
    rest = sizes.where(F.col("rows") < LEAST_ROWS).groupBy("lang").agg(F.sum("rows").alias("pool"))
    rest = staged(rest, "pool-sizes")
    last = rest.where(F.col("pool") < LEAST_ROWS).agg(F.sum("pool")).first()[0] or 0
    own = sizes.withColumnsRenamed({"lang": "l", "source": "s"}).join(
        small(rest, rest.count()).withColumnRenamed("lang", "m"), F.col("l").eqNullSafe(F.col("m")), "left")
    none = F.lit(None).cast("string")
    key = lambda level, lang, source: F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))
    own = own.select("l", "s", F.when(F.col("rows") >= LEAST_ROWS, key(0, F.col("l"), F.col("s")))
                     .when(F.col("pool") >= LEAST_ROWS, key(1, F.col("l"), none))
                     .when(F.lit(last >= LEAST_ROWS), key(2, none, none)).alias("grp"))
    return rows.join(small(own, sizes.count()), F.col("lang").eqNullSafe(F.col("l"))
                     & F.col("source").eqNullSafe(F.col("s")), "left").drop("l", "s")


def _standardised(rows: DataFrame) -> DataFrame:
    """Add ``z_*``: the statistics, pulled to their group's median by the
    length of the text, in units of their median deviation or least spread."""
    fit = rows.where("not base_failed and grp is not null")
    medians = staged(fit.groupBy("grp").agg(*[F.percentile_approx(c, 0.5, 10_000).alias(f"m_{c}") for c in NAMES]), "medians")
    n = medians.count()
    weight = F.col("n_words") / (F.col("n_words") + PRIOR_WORDS)
    rows = rows.join(small(medians, n), "grp", "left").withColumns(
        {f"z_{c}": (F.col(c) - F.col(f"m_{c}")) * weight for c in NAMES}).drop(*[f"m_{c}" for c in NAMES])
    rows = staged(rows.drop(*NAMES), "pulled")
    fit = rows.where("not base_failed and grp is not null")
    scales = staged(fit.groupBy("grp").agg(*[
        F.greatest(1.4826 * F.percentile_approx(F.abs(f"z_{c}"), 0.5, 10_000), F.lit(SPREAD[c])).alias(f"s_{c}") for c in NAMES]), "scales")
    rows = rows.join(small(scales, n), "grp", "left").withColumns({f"z_{c}": F.col(f"z_{c}") / F.col(f"s_{c}") for c in NAMES})
    rows = rows.withColumn("floor", F.array(*[(F.lit(SPREAD[c]) / F.col(f"s_{c}")) ** 2 for c in NAMES]))
    return staged(rows.drop(*[f"s_{c}" for c in NAMES]), "standardised")


def distance(mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance of the ``z_*`` of a row from a model."""
    y = [F.col(f"z_{c}") - mean[i] for i, c in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(P):
        inner = y[i] * inverse[i * P + i]
        for j in range(i + 1, P):
            inner = inner + F.lit(2.0) * y[j] * inverse[i * P + j]
        total = total + y[i] * inner
    return total


def _moments(values: list[Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.first("floor").alias("floor"),
            F.array(*[F.sum(v) for v in values]).alias("s1"),
            F.array(*[F.sum(values[i] * values[j]) for i in range(P) for j in range(i, P)]).alias("s2")]


MODEL = "grp struct<level:int,lang:string,source:string>, start int, mean array<double>, inverse array<double>, logdet double"


def _estimated(moments: DataFrame) -> DataFrame:
    """Models from rows of moments, one small matrix each."""
    upper = np.triu_indices(P)

    def work(batches):
        for b in batches:
            out = []
            for n, floor, s1, s2 in zip(b["n"], b["floor"], b["s1"], b["s2"]):
                mean = np.asarray(s1) / n
                cov = np.zeros((P, P))
                cov[upper] = np.asarray(s2) / n
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean) + np.diag(np.asarray(floor))
                out.append((mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.concat([b[["grp", "start"]], pd.DataFrame(out, columns=["mean", "inverse", "logdet"])], axis=1)

    return moments.mapInPandas(work, MODEL)


def _starts(z: DataFrame) -> DataFrame:
    """First models: the covariances of the vectors' hyperbolic tangents and of
    their spatial signs, and the plain norm."""
    cols = [F.col(f"z_{c}") for c in NAMES]
    length = F.sqrt(sum((c * c for c in cols[1:]), cols[0] * cols[0]))
    kinds = {0: [F.tanh(c) for c in cols], 1: [F.when(length > 0, c / length * math.sqrt(P)).otherwise(F.lit(0.0)) for c in cols]}
    parts = [z.groupBy("grp").agg(*_moments(v)).withColumn("start", F.lit(k)) for k, v in kinds.items()]
    found = _estimated(parts[0].unionByName(parts[1]))
    eye = F.array(*[F.lit(float(i == j)) for i in range(P) for j in range(P)])
    plain = z.select("grp").distinct().select(
        "grp", F.lit(2).alias("start"), F.array(*[F.lit(0.0)] * P).alias("mean"), eye.alias("inverse"), F.lit(0.0).alias("logdet"))
    return staged(found.unionByName(plain), "models")


def _step(z: DataFrame, model: DataFrame, n_models: int, share: float | None, limit: Column | None = None) -> DataFrame:
    """The model of the rows nearest to ``model``: of the ``share`` of least
    distance, or of those whose distance is within ``limit`` (a column of the model)."""
    keys = ["grp", "start"]
    near = z.join(small(model, n_models), "grp").withColumn("d", distance(F.col("mean"), F.col("inverse")))
    if limit is None:
        cut = staged(near.groupBy(*keys).agg(F.percentile_approx("d", share, 10_000).alias("cut")), "cuts")
        near = near.join(small(cut, n_models), keys)
        limit = F.col("cut")
    sums = near.where(F.col("d") <= limit).groupBy(*keys).agg(*_moments([F.col(f"z_{c}") for c in NAMES]))
    return staged(_estimated(sums), "models")


def _best(model: DataFrame) -> DataFrame:
    pick = F.min_by(F.struct("start", "mean", "inverse", "logdet"), F.struct("logdet", "start")).alias("m")
    return staged(model.groupBy("grp").agg(pick).select("grp", "m.*"), "models")


def chi2_quantile(p: int, upper: float) -> float:
    """The value that a chi-square of an even ``p`` exceeds with probability ``upper``."""
    tail = lambda x: math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))
    lo, hi = 0.0, 1.0
    while tail(hi) > upper:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid) > upper else (lo, mid)
    return hi


def fitted(z: DataFrame, share: float = SHARE) -> DataFrame:
    """The robust model of each group of ``z (grp, floor, z_*)``: ``grp, mean,
    inverse, logdet`` and ``factor``, by which distances exceed a chi-square.

    Two steps from every start, the least determinant goes on until it falls no
    more; then one reweighted step over the rows within the 97.5 percent
    quantile.  Medians and the cuts of steps are ``percentile_approx`` within
    1/10,000 of the rank, since an exact one would hold a group's values in one task.
    """
    model = _starts(z)
    groups = z.select("grp").distinct().count()
    for _ in range(2):
        model = _step(z, model, groups * len(STARTS), share)
    model = _best(model)
    for _ in range(STEPS):
        new = _step(z, model, groups, share)
        falls = new.select("grp", F.col("logdet").alias("now")).join(model, "grp").where(F.col("now") < F.col("logdet") - 1e-9)
        if falls.isEmpty():
            break
        model = new
    model = _scaled(z, model, groups)
    model = _step(z, model, groups, None, F.col("factor") * chi2_quantile(P, 0.025))
    return _scaled(z, model, groups)


def _scaled(z: DataFrame, model: DataFrame, groups: int) -> DataFrame:
    near = z.join(small(model, groups), "grp").select("grp", distance(F.col("mean"), F.col("inverse")).alias("d"))
    factor = near.groupBy("grp").agg(F.greatest(F.lit(1.0), F.percentile_approx("d", 0.5, 10_000) / chi2_quantile(P, 0.5)).alias("factor"))
    return staged(model.join(small(staged(factor, "factors"), groups), "grp"), "models")


def judge(docs: DataFrame, alpha: float = ALPHA, share: float = SHARE) -> DataFrame:
    """Counts and verdict of every row of ``docs (doc_id, text, lang, source)``:
    ``doc_id``, the five counts, ``base_failed``, ``kept``, and ``distance``: the
    squared Mahalanobis distance that decided, in units of a chi-square, null
    where none was taken.

    A text that fails the base rule (fewer than 20 words, or over 30 percent of
    them in repeated windows; null and empty texts too) is not kept and takes no
    part in the estimates.  Others are kept unless their distance exceeds the
    chi-square quantile of ``1 - alpha``.  Null languages and sources are values
    like any other.  Languages and sources of fewer than ``LEAST_ROWS`` texts are
    pooled by language, those of small pools altogether; a last pool of fewer
    rows is judged by the base rule alone.  Rows are judged each for itself, so
    repeated rows, null and repeated ids get one row each, and equal texts of
    one group one verdict; a distance equal to the limit is kept.  A very long
    text is one text.  An empty table gives an empty result; other columns are
    not read.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = staged(measured(docs).withColumn("base_failed", failed), "measured")
    rows = _standardised(_grouped(rows))
    z = rows.where("not base_failed and grp is not null").select("grp", "floor", *[f"z_{c}" for c in NAMES])
    model = fitted(z, share)
    near = distance(F.col("mean"), F.col("inverse")) / F.col("factor")
    out = rows.join(small(model, model.count()), "grp", "left").withColumn("distance", F.when(~F.col("base_failed"), near))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(P, alpha), F.lit(True))
    return out.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "distance")
