"""O1 / W4 as a keyed permutation: a row's place in an epoch by arithmetic.

Sorting by a hash moves every row once per epoch.  Here the rows get a dense
ordinal ``0 .. n-1`` once, and each epoch's order is a permutation of these
numbers that is computed from the ordinal, the seed and the epoch alone: no sort,
no exchange, and it can be inverted, so "which row comes at place p of epoch e"
needs no index either.

The permutation is a Feistel network over pairs ``(l, r)``, ``l < a``, ``r < b``
with ``a * b >= n`` just above n.  Numbers from n on that come out are put in
again until one below n comes out (cycle walking), which keeps it a bijection of
``0 .. n-1``.  There are fewer than ``a`` numbers to walk through, about sqrt(n).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.ordered import positions

ROUNDS = 6  # even: after a pass both halves are in their places again
#: Passes of a walk at most, for small and for other ``n``.  Up to ``SMALL`` they
#: suffice for sure.  Beyond that about one number in sqrt(n) needs a second pass
#: and one in n^(PASSES/2) a further one than these, which would raise an error.
SMALL, PASSES = 4096, 8
#: A prime below 2^31: products of two remainders fit into a long.
P = 2_147_483_647


def halves(n: int) -> tuple[int, int]:
    """``(a, b)`` with ``a * b >= n`` and fewer than ``a`` numbers too many."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int, epoch: int) -> list[tuple[int, int]]:
    """Two numbers below ``P`` for each round."""
    x, out = (seed * 1_000_003 + epoch * 8_191 + 12_345) % P, []
    for _ in range(ROUNDS):
        pair = []
        for _ in range(2):
            x = (x * 48_271 + 11) % P
            pair.append(x)
        out.append((pair[0], pair[1]))
    return out


def _mix(x: Column, k0: Column, k1: Column) -> Column:
    """A number below ``P`` from ``x`` and a round's key; every step fits a long."""
    y = (x % P * k0 + k1) % P
    y = (y * y + k0) % P
    return (y * y + k1) % P


def _rounds(n: int, seed: int, epoch: int, inverse: bool) -> Column:
    """The rounds of all passes as a constant array: the size of the half that
    changes, the key, and whether a further pass begins here."""
    a, b = halves(n)
    once = [(a if i % 2 == 0 else b, *key) for i, key in enumerate(round_keys(seed, epoch))]
    once = once[::-1] if inverse else once
    passes = a * b - n + 1 if n <= SMALL else PASSES
    literal = [f"named_struct('own', {own}L, 'k0', {k0}L, 'k1', {k1}L, 'again', {'true' if p and not i else 'false'})"
               for p in range(passes) for i, (own, k0, k1) in enumerate(once)]
    return F.expr(f"array({', '.join(literal)})")  # one text: far fewer calls than a Column for each number


def permuted(x: Column, n: int, seed: int, epoch: int, inverse: bool = False) -> Column:
    """The place of ordinal ``x`` (below ``n``) in an epoch's order, or with
    ``inverse`` the ordinal at place ``x``.  Built-in expressions only."""
    if n <= 1:
        return x.cast("bigint")
    _, b = halves(n)
    x, size, no = x.cast("bigint"), F.lit(b).cast("bigint"), F.lit(False)
    start = F.struct(F.call_function("div", x, size).alias("l"), (x % size).alias("r"), no.alias("done"))

    def turn(s: Column, k: Column) -> Column:
        if not inverse:  # (l, r) -> (r, l + f(r))
            l, r = s["r"], (s["l"] + _mix(s["r"], k["k0"], k["k1"])) % k["own"]
        else:  # (l, r) -> (r - f(l), l)
            l, r = ((s["r"] - _mix(s["l"], k["k0"], k["k1"])) % k["own"] + k["own"]) % k["own"], s["l"]
        ended = s["done"] | (k["again"] & (s["l"] * size + s["r"] < n))
        return F.when(ended, F.struct(s["l"].alias("l"), s["r"].alias("r"), F.lit(True).alias("done"))).otherwise(
            F.struct(l.alias("l"), r.alias("r"), no.alias("done")))

    def number(s: Column) -> Column:
        v = s["l"] * size + s["r"]
        return F.when(v < n, v).otherwise(F.raise_error(F.lit("a walk did not end")).cast("bigint"))

    return F.aggregate(_rounds(n, seed, epoch, inverse), start, turn, number)


def ordinals(df: DataFrame, row_id: str = "row_id", name: str = "ordinal") -> DataFrame:
    """``(row_id, ordinal)``: the rows numbered in the order of ``row_id``, once
    for all epochs (sampled range partitions, see :mod:`tessera.operators.ordered`)."""
    return positions(df.select(row_id), order_cols=[row_id], name=name)


def epoch_orders(numbered: DataFrame, n: int, epochs: int, seed: int, ordinal: str = "ordinal",
                 start: int = 0) -> DataFrame:
    """``numbered`` (``n`` rows with ordinals) once per epoch, with ``epoch`` and
    ``pos``.  Narrow: nothing moves, whatever the number of epochs."""
    rows = [F.struct(F.lit(e).alias("epoch"), permuted(F.col(ordinal), n, seed, e).alias("pos"))
            for e in range(start, start + epochs)]
    return numbered.withColumn("_e", F.explode(F.array(*rows))).select(
        *numbered.columns, F.col("_e.epoch").alias("epoch"), F.col("_e.pos").alias("pos"))


def rows_at(places: DataFrame, n: int, seed: int, epoch: int, pos: str = "pos", ordinal: str = "ordinal") -> DataFrame:
    """Add the ordinal of the row that comes at ``pos`` in an epoch: a rank that
    knows its places finds its rows without any index."""
    return places.withColumn(ordinal, permuted(F.col(pos), n, seed, epoch, inverse=True))
