"""Numeric and formatting column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, places: int = 4) -> Column:
    """Numpy-style ``np.round(x, places)``: round the scaled double to
    the nearest integer, ties to even, then scale back."""
    scale = float(10 ** places)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


#: Values below this size are summed as decimals with 12 places.
EXACT_BELOW = 1e9


def exact_mean_rounded(c, places: int = 4) -> Column:
    """Aggregate: the mean of ``c`` rounded half-even to ``places``.

    Values below ``EXACT_BELOW`` in size are summed as decimals with 12
    places (the noise of a double lies below them), so the result does not depend on the order in which partial sums
    meet (a double sum does, in its last bits, and a mean that lies on a
    rounding tie would then round either way).  With a larger value in the
    group the plain double mean is rounded.  NaN, or infinities of both
    signs, give NaN; infinities of one sign give that infinity.  Null values
    are ignored, as by ``avg``."""
    x = _col(c).cast("double")
    inf = F.lit(float("inf"))
    small = ~F.isnan(x) & (F.abs(x) < F.lit(EXACT_BELOW))
    d = F.when(small, x).cast("decimal(38,12)")
    count_if = lambda cond: F.count(F.when(cond, F.lit(1)))
    high, low = count_if(x == inf) > 0, count_if(x == -inf) > 0
    exact = F.bround(F.sum(d) / F.count(d).cast("decimal(20,0)"), places).cast("double")
    return (F.when((count_if(F.isnan(x)) > 0) | (high & low), F.lit(float("nan")))
            .when(high, inf).when(low, -inf)
            .when(count_if(~small) > 0, round_half_even(F.avg(x), places))
            .otherwise(exact))


def argmax(c) -> Column:
    """Index of the first maximum of an array (NaN counts as greatest,
    as in numpy)."""
    a = _col(c)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def py_float_text(c) -> Column:
    """Python ``str()`` of a value already rounded to 4 places
    (``0.1234``, ``1.0``, ``12.5``, ``nan``, ``inf``, ``1e+16``); null becomes
    ``None``.

    Going through ``decimal(38,4)`` avoids the ``1.0E-4`` form of a plain
    cast; trailing zeros are then cut back to one digit after the point.
    """
    x = _col(c)
    plain = ~F.isnan(x) & (F.abs(x) < F.lit(1e16))
    other = (F.when(F.isnan(x), F.lit("nan")).when(x == F.lit(float("inf")), F.lit("inf"))
             .when(x == F.lit(float("-inf")), F.lit("-inf"))
             .otherwise(F.replace(F.replace(x.cast("string"), F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e+"))))
    d = F.when(plain, x).cast("decimal(38,4)").cast("string")
    trimmed = F.regexp_replace(d, "0+$", "")
    text = F.when(F.endswith(trimmed, F.lit(".")), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
    return F.when(x.isNull(), F.lit("None")).when(plain, text).otherwise(other)


def percent(used, total) -> Column:
    """``100 * used / total``; a total of 0 gives null instead of an
    error."""
    return F.lit(100.0) * _col(used).cast("double") / F.nullif(_col(total).cast("double"), F.lit(0.0))


def format_minutes(seconds) -> Column:
    """Elapsed seconds as ``'%.2f min'``."""
    return F.format_string("%.2f min", _col(seconds) / F.lit(60.0))
