"""O1 / W4 as a keyed permutation."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import permute


def order(spark, n, seed=84, epoch=0, inverse=False):
    df = spark.range(n).withColumn("pos", permute.permuted(F.col("id"), n, seed, epoch, inverse))
    return [r["pos"] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 16, 17, 97, 100, 101, 1000, 4097, 20_000])
def test_bijection_and_inverse(spark, n):
    got = order(spark, n, epoch=1)
    assert sorted(got) == list(range(n))
    back = order(spark, n, epoch=1, inverse=True)
    assert [back[p] for p in got] == list(range(n))


def test_epochs_and_seeds_differ_and_look_random(spark):
    n = 3000
    a, b, c = order(spark, n), order(spark, n, epoch=1), order(spark, n, seed=85)
    for x, y in ((a, b), (a, c), (a, list(range(n)))):
        assert sum(p == q for p, q in zip(x, y)) < 12  # about one by chance
        steps = [abs(p - q) for p, q in zip(x, x[1:])]
        assert abs(sum(steps) / len(steps) - n / 3) < n / 20  # neighbours are torn apart
    first = sum(p < n // 2 for p in a[: n // 2])
    assert abs(first - n // 4) < 120
    assert a == order(spark, n)


def test_large_numbers(spark):
    n = 10 ** 15 + 7
    xs = [0, 1, 12345, 10 ** 14, n // 2, n - 1]
    df = spark.createDataFrame([(x,) for x in xs], "id bigint")
    df = df.withColumn("pos", permute.permuted(F.col("id"), n, 1, 2))
    df = permute.rows_at(df, n, 1, 2).collect()
    assert all(0 <= r["pos"] < n and r["ordinal"] == r["id"] for r in df) and len({r["pos"] for r in df}) == len(xs)


def test_no_exchange_behind_the_ordinals(spark):
    numbered = spark.range(1000).select((F.col("id") * 3).alias("row_id"), F.col("id").alias("ordinal"))
    out = permute.epoch_orders(numbered, 1000, 3, 84)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan
    per = {r["epoch"]: (r["n"], r["s"]) for r in out.groupBy("epoch").agg(
        F.countDistinct("pos").alias("n"), F.sum("pos").alias("s")).collect()}
    assert per == {e: (1000, 999 * 500) for e in range(3)}


def test_ordinals(spark):
    df = spark.createDataFrame([(7,), (3,), (900,), (-4,)], "row_id bigint")
    assert {r["row_id"]: r["ordinal"] for r in permute.ordinals(df).collect()} == {-4: 0, 3: 1, 7: 2, 900: 3}
