"""A2-A4 for doubles of any size: sums that do not depend on the order.

A double is an integer times a power of two.  Values are binned by exponent; in
a bin all are integer multiples of one unit, and integers add up exactly in any
order.  The bins of a key are few (at most 263 for all doubles there are, three
or four for losses), and only their sums meet in the end, as exact fractions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Exponents of a bin; with 53 bits of a double and one to spare, multiples of a
#: bin's unit stay below 2^62.
WIDTH = 8
SPARE = 53


def _unit_exponent(k: int) -> int:
    return WIDTH * k - SPARE


def binned(x: Column) -> tuple[Column, Column]:
    """The bin of a finite double and the multiple of the bin's unit that it is.

    The bin may come out one off at a power of two (a logarithm is rounded); the
    spare bit keeps the multiple an integer all the same.  The scaling is done in
    two steps, since its factor alone may be beyond the range of doubles.
    """
    k = F.when(x == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs(x)) / F.lit(float(WIDTH)))).cast("int")
    shift = F.lit(SPARE) - k * F.lit(WIDTH)
    half = F.call_function("div", shift, F.lit(2)).cast("int")
    scaled = x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half)
    return k, scaled.cast("bigint")


def _half_even(x: Fraction, places: int) -> Fraction:
    return Fraction(round(x * 10 ** places), 10 ** places)


def mean_of_bins(bins: dict[int, int], n: int, places: int, noise: int | None) -> float:
    """The mean of ``n`` values from the sums of their bins, rounded half-even.
    The exact sum is first taken at ``noise`` decimal places if it is that small."""
    total = sum((Fraction(s) * Fraction(2) ** _unit_exponent(k) for k, s in bins.items()), Fraction(0))
    if noise is not None:
        total = _half_even(total, noise)
    out = _half_even(total / n, places)
    try:
        return float(out)
    except OverflowError:
        return math.inf if out > 0 else -math.inf


def exact_mean(df: DataFrame, keys: Sequence[str], value: str, places: int = 4, noise: int | None = 12,
               name: str = "mean", count: str = "n") -> DataFrame:
    """The exactly computed mean of ``value`` per key, rounded half-even to
    ``places``, and the number of rows.

    Losses come from decimal numbers, of which doubles are off by a little; the
    exact sum is therefore rounded to ``noise`` decimal places before it is
    divided (None: not), so a mean that lies on a tie in decimals is one here.
    Nulls are ignored in the mean and counted as rows; a key of nulls has a null
    mean.  NaN, or infinities of both signs, give NaN, of one sign that infinity.
    Null keys are keys like any other.

    Sums are taken per key and bin with map-side combination, so a hot key is
    spread over the tasks that read it; what meets per key are its bins.
    """
    keys = list(keys)
    x = F.col(value).cast("double")
    inf = F.lit(math.inf)
    finite = ~F.isnan(x) & (F.abs(x) != inf)
    k, m = binned(F.when(finite, x))
    kind = F.when(x.isNull(), 0).when(F.isnan(x), 2).when(x == inf, 3).when(x == -inf, 4).otherwise(1)
    per_bin = df.select(*keys, kind.alias("_kind"), F.coalesce(k, F.lit(0)).alias("_bin"), m.alias("_m")).groupBy(
        *keys, "_kind", "_bin").agg(F.sum(F.col("_m").cast("decimal(38,0)")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    sums = per_bin.groupBy(*keys).agg(F.collect_list(F.struct(
        "_kind", "_bin", F.col("_s").cast("string").alias("_s"), "_n")).alias("_b"))

    def finish(bins: pd.Series) -> pd.Series:
        out = []
        for rows in bins:
            rows = [(int(r["_kind"]), int(r["_bin"]), r["_s"], int(r["_n"])) for r in rows]
            kinds = {r[0] for r in rows}
            n = sum(r[3] for r in rows if r[0] == 1)
            if 2 in kinds or {3, 4} <= kinds:
                out.append(math.nan)
            elif kinds & {3, 4}:
                out.append(math.inf if 3 in kinds else -math.inf)
            else:
                out.append(mean_of_bins({r[1]: int(r[2]) for r in rows if r[0] == 1}, n, places, noise) if n else None)
        # as text, since pandas does not tell a NaN from a null
        return pd.Series([None if v is None else repr(v) for v in out], dtype=object)

    mean = F.pandas_udf(finish, "string")(F.col("_b")).cast("double")
    rows = F.aggregate("_b", F.lit(0).cast("bigint"), lambda a, r: a + r["_n"])
    return sums.select(*keys, mean.alias(name), rows.alias(count))
