"""Document quality by Bradley-Terry pairwise ranking.

Plain statistics of the text (word repetition, symbols, case, lengths, lines)
and their quantile bins are the features.  From labelled documents, pairs of a
good and a bad one are drawn; the model is the weight vector for which the
logistic loss on feature differences is least, so a document's raw score is
its strength in the Bradley-Terry sense.  Documents below the quantile of raw
scores that equals the share of bad labels are to be rejected; the returned
score is a logistic function of the raw score that is ``threshold`` there.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import in_small_batches, runs, staged

#: ASCII classes counted by deleting them from the UTF-8 bytes.
CLASSES = {"end": b".!?", "comma": b",;:", "loud": b"!?", "symbol": b"#$%&*@^~+=<>{}[]\\/_|", "pipe": b"|",
           "quote": b"\"'`()-", "digit": b"0123456789", "upper": bytes(range(65, 91)), "line": b"\n"}
BINS = 10


def statistics(text: bytes | None) -> list[float]:
    t = text or b""
    words = t.split()
    n, size = max(len(words), 1), max(len(t), 1)
    counts = Counter(words)
    lines = [x for x in t.split(b"\n") if x.strip()]
    top = max(counts.values(), default=0)
    lengths = list(map(len, words))
    return [
        math.log1p(len(t)), math.log1p(len(words)),
        len(counts) / n, math.log1p(len(counts)) / math.log1p(n) if words else 0.0, top / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(lengths) / n, math.log1p(max(lengths, default=0)),
        sum(c for w, c in counts.items() if len(w) <= 3) / n,
        sum(c for w, c in counts.items() if not w[-1:].isalpha() and w[-1] < 128) / n,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        len(lines) / n, len(set(lines)) / max(len(lines), 1),
        *[(len(t) - len(t.translate(None, c))) / size for c in CLASSES.values()],
    ]


@dataclass
class Ranking:
    """A fitted model: bin edges, scaling, weights, and the raw score to keep from."""
    edges: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def features(self, x: np.ndarray) -> np.ndarray:
        steps = (x[:, :, None] > self.edges[None, :, :]).reshape(len(x), -1)
        return np.hstack([np.clip((x - self.mean) / self.scale, -4, 4), steps])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.cut) + math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, threshold: float, pairs: int = 40_000, ridge: float = 3.0,
        seed: int = 5) -> Ranking:
    """Fit on statistics ``x`` and boolean labels.  Without both labels every
    document scores alike, on the side of the label that there is."""
    width = x.shape[1] if x.ndim == 2 and len(x) else len(statistics(b""))
    x = x.reshape(-1, width)
    blank = Ranking(np.zeros((width, BINS - 1)), np.zeros(width), np.ones(width), np.zeros(width * BINS), 0.0, 1.0, threshold)
    if not len(x) or good.all() or not good.any():
        if len(x) and not good.any():
            blank.cut = 1.0
        return blank
    edges = np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T
    model = Ranking(edges, x.mean(axis=0), x.std(axis=0) + 1e-9, blank.weights, 0.0, 1.0, threshold)
    f = model.features(x)
    rng = np.random.default_rng(seed)
    a = rng.choice(np.flatnonzero(good), pairs)
    b = rng.choice(np.flatnonzero(~good), pairs)
    diff = f[a] - f[b]
    w = np.zeros(diff.shape[1])
    for _ in range(25):  # Newton steps on the logistic loss of the differences
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (1 - p) - ridge * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    model.weights = w
    raw = f @ w
    model.cut = float(np.quantile(raw, (~good).mean()))
    spread = float(np.quantile(raw, 0.9) - np.quantile(raw, 0.1))
    model.slope = 8.0 / spread if spread > 0 else 1.0
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by 5 (a null id: yes)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 20_000) -> Ranking:
    """Fit on at most ``sample`` labelled training documents, the first in the
    order of a hash of their ids.  Null labels and ids are left out; of several
    labels of one id the lowest counts."""
    docs = in_small_batches(docs)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    known = staged(known.orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(sample), "labelled")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(known), "doc_id")
    rows = _with_statistics(texts, "quality").orderBy("doc_id", F.xxhash64("x")).limit(2 * sample).toPandas()
    x = np.array(rows["x"].tolist(), dtype=np.float64)
    return fit(x, rows["quality"].to_numpy() == 1, threshold)


def _with_statistics(texts: DataFrame, label: str) -> DataFrame:
    def work(batches):
        for b in batches:
            t = list(b["text"])
            for lo, hi in runs([len(x or b"") for x in t]):
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[lo:hi].to_numpy(), label: b[label].iloc[lo:hi].to_numpy(),
                                    "x": [statistics(x) for x in t[lo:hi]]})

    return texts.select(F.col("doc_id").cast("bigint"), F.col(label).cast("int"), "text").mapInPandas(
        work, f"doc_id bigint, {label} int, x array<double>")


def score_column(model: Ranking):
    """A column function from text to score."""
    def scores(texts: pd.Series) -> pd.Series:
        t = list(texts)
        out = [np.zeros(0)]
        for lo, hi in runs([len(x or b"") for x in t]):
            out.append(model.score(np.array([statistics(x) for x in t[lo:hi]])))
        return pd.Series(np.concatenate(out))

    return F.pandas_udf(scores, "double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 20_000) -> DataFrame:
    """Score every document ``(doc_id, text, ...)``: ``doc_id``, ``held_out``,
    ``score`` and ``predicted`` (1 from ``threshold`` on).

    Only the text enters a score, so equal texts have equal scores; a null text
    scores as an empty one.  Rows are judged each for itself, repeated ids and
    null ids included (a null id is held out).  An empty table gives an empty
    result.
    """
    model = train(docs, labels, threshold, sample)
    score = score_column(model)(F.col("text").cast("binary"))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` predicts to be good, whole."""
    model = train(docs, labels, threshold, sample)
    return docs.where(score_column(model)(F.col("text").cast("binary")) >= threshold)
