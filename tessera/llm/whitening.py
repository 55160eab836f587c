"""Whitening of embeddings with components found by contour integration (FEAST).

Vectors become integers, so their sums and centred products are exact in any
order and a rerun gives the same covariance, bit by bit.  Its leading
eigenpairs are found by intervals: inertia counts (signs of the pivots of an
LDL' factorisation of the shifted matrix) cut the spectrum into intervals of a
few eigenvalues each.  In each interval, quadrature along a circle around it,
``sum of w (zI - V)^-1 Y`` over complex shifts z, projects a random block onto
the eigenvectors inside; a Rayleigh-Ritz step extracts them; both are repeated
until the residuals vanish.  An interval is done when as many pairs lie in it
as the inertia counts say, so none is missed.  Intervals are independent and
are solved by a task each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import in_small_batches, staged

SCALE, SHIFT = 64, 1_000_000
#: Entries are held within this, so that they remain exact integers in a double.
LARGEST = 1 << 52
#: Eigenvalues of an interval at most, unless they are as good as equal.
INTERVAL = 12
#: Shifts on the upper half of a circle (the lower half is their conjugate).
NODES = 16
ROUNDS = 60
#: Share of the largest eigenvalue below which a direction counts as constant.
FLAT = 1e-11
#: Partial matrices of so many groups of tasks are summed before the rest.
SALTS = 64


# --- dense symmetric matrices, once per interval -------------------------------------

def inertia(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above 0, by the pivots of
    an LDL' factorisation with full diagonal pivoting (Bunch and Parlett)."""
    a = matrix.copy()
    above = 0
    while len(a):
        n = len(a)
        d = np.abs(np.diag(a))
        i = int(d.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        p, q = divmod(int(off.argmax()), n)
        if max(d[i], off[p, q]) == 0:
            return above
        if d[i] >= (1 + 17 ** 0.5) / 8 * off[p, q]:
            above += int(a[i, i] > 0)
            take, rest = [i], np.delete(np.arange(n), i)
        else:  # a pivot of two rows with a negative determinant: one eigenvalue on each side
            above += 1
            take, rest = [p, q], np.delete(np.arange(n), [p, q])
        c = a[np.ix_(rest, take)]
        a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(a[np.ix_(take, take)], c.T)
        a = (a + a.T) / 2
    return above


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals ``(low, high, count)`` from the top that hold the ``wanted``
    largest eigenvalues of ``v`` (and the rest of the last interval)."""
    n = len(v)
    eye = np.eye(n)
    top = float(np.abs(v).sum(axis=1).max())  # no eigenvalue is above the largest absolute row sum
    if top <= 0:
        return []
    top *= 1 + 1e-9
    over: dict[float, int] = {}

    def above(x: float) -> int:
        if x not in over:
            over[x] = inertia(v - x * eye)
        return over[x]

    lo, hi = FLAT * top, top
    wanted = min(wanted, above(lo))
    if not wanted:
        return []
    while above(lo) > wanted and hi - lo > 1e-9 * hi:  # the bisected end that still holds enough
        mid = (lo + hi) / 2
        if above(mid) >= wanted:
            lo = mid
        else:
            hi = mid
    todo, done = [(lo, top)], []
    while todo:
        a, b = todo.pop()
        count = above(a) - above(b) if b < top else above(a)
        if not count:
            continue
        mid = (a + b) / 2
        if count <= INTERVAL and b - a <= 0.5 * b or b - a <= 1e-9 * b:
            done.append((a, b, count))
        else:
            todo += [(a, mid), (mid, b)]
    return sorted(done, reverse=True)


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in ``(low, high]`` by contour integration."""
    n = len(v)
    scale = float(np.abs(v).sum(axis=1).max())
    middle, radius = (low + high) / 2, (high - low) / 2
    radius = max(radius, 1e-7 * scale)  # a circle wider than equal eigenvalues are apart in doubles
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = (x + 1) * np.pi / 2
    shifts = middle + radius * np.exp(1j * angle)
    rng = np.random.default_rng(seed)
    size = min(n, count + max(4, count // 2))
    y = rng.standard_normal((n, size))
    factors = [np.linalg.inv(z * np.eye(n) - v) for z in shifts]
    edge, last = 1e-12 * scale, np.inf
    for round_ in range(ROUNDS):
        # 1/(2 pi i) of the contour integral: twice the real part of its upper half
        q = sum((wk / 2 * radius * np.exp(1j * t) * (f @ y)).real for t, wk, f in zip(angle, w, factors))
        q, _ = np.linalg.qr(q)
        ritz, u = np.linalg.eigh(q.T @ v @ q)
        x_ = q @ u
        inside = (ritz > low - edge) & (ritz <= high + edge)
        if inside.sum() >= count:
            at = np.flatnonzero(inside)
            residual = np.linalg.norm(v @ x_[:, at] - x_[:, at] * ritz[at], axis=0)
            best = at[np.sort(np.argsort(residual, kind="stable")[:count])]
            worst = np.sort(residual)[:count].max()
            # as small as rounding lets it be: tiny, or small and no longer halved by a round
            if worst <= 1e-15 * scale or worst <= 1e-12 * scale and worst > last / 2:
                return ritz[best], x_[:, best]
            last = worst
        if round_ % 8 == 7 and size < n:  # too many neighbours just outside: a wider block
            size = min(n, 2 * size)
            x_ = np.hstack([x_, rng.standard_normal((n, size - x_.shape[1]))])
        y = x_
    raise ArithmeticError(f"found {int(inside.sum())} of {count} eigenvalues between {low} and {high}")


# --- over the table --------------------------------------------------------------------

def integers(vectors: list) -> np.ndarray:
    x = np.floor(SCALE * np.asarray(vectors, dtype=np.float64))
    return np.clip(x, -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector holds neither nulls nor non-finite entries."""
    e = F.col("embedding")
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select("vec_id", e.cast("array<double>").alias("embedding")).where(e.isNotNull() & ~bad)


def _sums(vectors: DataFrame) -> DataFrame:
    """Per vector length and dimension the number of vectors and the exact sum."""
    def work(batches):
        total: dict[int, list] = {}
        for b in batches:
            lengths = b["embedding"].map(len).to_numpy()
            for size in np.unique(lengths):
                x = integers(b["embedding"][lengths == size].tolist())
                at = total.setdefault(int(size), [0, [0] * int(size)])
                at[0] += len(x)
                # 2,000 entries of 2^53 fit into a long; beyond that Python's integers go on
                for lo in range(0, len(x), 500):
                    at[1] = [s + int(t) for s, t in zip(at[1], x[lo:lo + 500].sum(axis=0))]
        for size, (n, sums) in total.items():
            yield pd.DataFrame({"size": size, "dim": np.arange(size), "n": n,
                                "total": pd.Series([str(s) for s in sums], dtype=object)})

    part = vectors.select("embedding").mapInPandas(work, "size int, dim int, n bigint, total string")
    return part.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def products(rows: DataFrame, centred, width: int) -> np.ndarray:
    """Sum of outer products of ``centred(embeddings)`` over all rows.

    A task adds its rows up to one matrix and hands it on row by row; the
    matrices are summed in two steps, so no task gets more than a share of them.
    What reaches the driver is one matrix, whatever the number of rows.
    """
    def work(batches):
        total = np.zeros((width, width))
        for b in batches:
            if len(b):
                y = centred(b["embedding"].tolist())
                total += y.T @ y
        salt = int(np.random.default_rng().integers(SALTS))
        yield pd.DataFrame({"i": np.arange(width), "salt": salt, "row": list(total)})

    def add(key, part):
        return pd.DataFrame({"i": [key[0]], "row": [np.sum(np.stack(part["row"].tolist()), axis=0)]})

    part = staged(rows.select("embedding").mapInPandas(work, "i int, salt int, row array<double>"), "products")
    some = part.groupBy("i", "salt").applyInPandas(add, "i int, row array<double>")
    whole = some.groupBy("i").applyInPandas(add, "i int, row array<double>").collect()
    out = np.zeros((width, width))
    for r in whole:
        out[r["i"]] = r["row"]
    return out


def components(spark, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs of the covariance ``v`` (fewer where it
    has fewer above ``FLAT`` of its largest), largest first, unit vectors in columns.

    One row per interval, one task each; a last Rayleigh-Ritz step over all
    found vectors makes them orthogonal across intervals.
    """
    parts = intervals(v, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))

    def work(batches):
        for b in batches:
            for low, high, count in zip(b["low"], b["high"], b["count"]):
                values, vectors = feast(v, low, high, int(count))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    frame = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts), "low")
    found = frame.mapInPandas(work, "value double, vector array<double>").collect()
    if len(found) != sum(p[2] for p in parts):
        raise ArithmeticError("the intervals' eigenpairs are not as many as the inertia counts say")
    x, _ = np.linalg.qr(np.array([r["vector"] for r in sorted(found, key=lambda r: -r["value"])]).T)
    ritz, u = np.linalg.eigh(x.T @ v @ x)
    order = np.argsort(-ritz)[:wanted]
    order = order[ritz[order] > FLAT * ritz.max()]
    x = (x @ u)[:, order]
    x *= np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1, 1)  # the largest entry is positive
    return ritz[order], x


def whiten(vectors: DataFrame, wanted: int = 32) -> DataFrame:
    """Whitened components of ``vectors (vec_id, embedding)``: a row for each
    usable vector and component, as the module's contract lists them.

    Vectors that are null or hold null or non-finite entries are left out, and
    so are vectors whose length is not the table's most frequent one (of equally
    frequent lengths the longest): they belong to another space.  Components of
    no variance (at most ``FLAT`` of the largest) cannot be whitened and have no
    rows, so a single vector, equal vectors and an empty table give none.
    Repeated rows and null or repeated ids are rows like any other.  Entries
    beyond ``LARGEST`` (2^52, after scaling) count as that; ``deviation`` is null
    where it is beyond a long.  Equal eigenvalues have any orthonormal basis of
    their space, the same for all rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    rows = in_small_batches(_usable(vectors))
    sums = staged(_sums(rows), "sums")
    best = sums.groupBy("size").agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), F.col("size").desc()).limit(1).collect()
    if not best:
        return spark.createDataFrame([], schema)
    width, n = best[0]["size"], best[0]["n"]
    total = [int(r["total"]) for r in sums.where(F.col("size") == width).orderBy("dim").collect()]  # one row per dimension
    rows = rows.where(F.size("embedding") == width)

    base = np.array([t // n for t in total], dtype=np.int64)
    rest = np.array([(t - n * int(b)) / n for t, b in zip(total, base)])
    exact = products(rows, lambda e: (integers(e) - base).astype(np.float64), width)
    v = exact / n - np.outer(rest, rest)
    values, x = components(spark, v, wanted)
    if not len(values):
        return spark.createDataFrame([], schema)
    onto = x / np.sqrt(values)

    def white(e) -> np.ndarray:
        return ((integers(e) - base) - rest) @ onto

    error = float(np.abs(products(rows, white, len(values)) / n - np.eye(len(values))).max())
    explained = values / np.trace(v)

    def deviations(e) -> list:
        x_ = integers(e)
        y = x_ * n - np.array(total) if n * LARGEST < 1 << 62 or np.abs(x_).max() < (1 << 62) // n else None
        if y is not None and float(np.abs(y).max(initial=0)) ** 2 * width < 2 ** 62:
            return (y * y).sum(axis=1).tolist()
        whole = [sum((n * int(c) - t) ** 2 for c, t in zip(row, total)) for row in x_]
        return [d if d < 1 << 63 else None for d in whole]

    def work(batches):
        for b in batches:
            if len(b):
                e = b["embedding"].tolist()
                yield pd.DataFrame({"vec_id": b["vec_id"].to_numpy(), "named": b["named"].to_numpy(),
                                    "deviation": pd.Series(deviations(e), dtype="Int64"), "w": list(white(e))})

    vec_id = F.col("vec_id").cast("bigint")
    out = rows.select(F.coalesce(vec_id, F.lit(0)).alias("vec_id"), vec_id.isNotNull().alias("named"), "embedding").mapInPandas(
        work, "vec_id bigint, named boolean, deviation bigint, w array<double>")
    share = F.array(*[F.lit(float(s)) for s in explained])
    out = out.select(F.when(F.col("named"), F.col("vec_id")).alias("vec_id"), "deviation", F.posexplode("w").alias("pos", "whitened"))
    return out.select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.element_at(share, F.col("pos") + 1).alias("explained"), F.lit(error).alias("identity_error"))
