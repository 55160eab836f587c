"""S8 with locators: payload stored once, a rank reads its row groups only."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators.feed import assign_rank, shuffle_position
from tessera.session import staging_path
from tessera.sources import prepared
from tests.helpers import rows


def encode(df):
    return df.select("row_id", F.transform(F.split("text", ""), lambda c: F.ascii(c)).alias("ids"))


def texts(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(
        (F.col("id") * 7 + 1).alias("row_id"), F.repeat(F.concat(F.lit("t"), F.col("id")), 5).alias("text"))


def order(t, epochs, world=4):
    return assign_rank(shuffle_position(t, epochs=epochs, seed=3), world_size=world).select(
        "epoch", "rank", "pos_in_rank", "row_id", "is_padding")


def local(path):
    return path.replace("file:", "")


def payload_bytes(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{local(path)}/payload/*.parquet"))


def build(spark, n=1000, epochs=2, group_rows=50, world=4):
    t = texts(spark, n)
    path = staging_path(spark, "store-test")
    prepared.write_store(t, order(t, epochs, world), path, encode, group_rows=group_rows)
    return t, path


def scanned(df):
    """Rows that left the payload's Parquet scan, and the files they came from."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStageExec" in node.getClass().getSimpleName():
            return walk(node.plan())
        if "FileSourceScanExec" in node.getClass().getSimpleName() and "ids" in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(found)


def test_payload_does_not_grow_with_epochs(spark):
    (_, one), (_, five) = build(spark, epochs=1), build(spark, epochs=5)
    assert payload_bytes(one) == payload_bytes(five)
    assert spark.read.parquet(f"{five}/payload").count() == 1000
    assert spark.read.parquet(f"{five}/locators").count() == 5 * 1000


def test_locators_name_the_row(spark):
    """File, row group and offset lead to the row without Spark."""
    _, path = build(spark, group_rows=50)
    seen = 0
    for r in spark.read.parquet(f"{path}/locators").collect():
        f = pq.ParquetFile(f"{local(path)}/payload/{r['file']}")
        group = f.read_row_group(r["row_group"] % prepared._GROUPS_OF_A_FILE, columns=["row_id", "_group"])
        assert group["row_id"][r["offset"]].as_py() == r["row_id"]
        assert set(group["_group"].to_pylist()) == {r["row_group"]}
        seen += 1
        if seen >= 60:
            break
    sizes = [pq.ParquetFile(f).metadata.row_group(g).num_rows for f in glob.glob(f"{local(path)}/payload/*.parquet")
             for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert max(sizes) == 50 and sum(sizes) == 1000


def test_reading_equals_the_order(spark):
    t, path = build(spark, n=333, epochs=3, group_rows=10)
    want = order(t, 3).join(encode(t), "row_id")
    cols = ["epoch", "rank", "pos_in_rank", "row_id", "is_padding", "ids"]
    assert rows(prepared.read_store(spark, path), cols) == rows(want, cols)
    one = prepared.read_store(spark, path, epoch=1, rank=2)
    assert rows(one, cols) == rows(want.where("epoch = 1 and rank = 2"), cols)


def test_a_rank_reads_its_row_groups_only(spark):
    """Of 100 row groups a rank of 5 rows needs 5 at most."""
    t, path = build(spark, n=1000, epochs=2, group_rows=10, world=200)
    got = prepared.read_store(spark, path, epoch=1, rank=17)
    groups = spark.read.parquet(f"{path}/groups").where("epoch = 1 and rank = 17")
    needed, total = groups.count(), groups.agg(F.sum("rows")).first()[0]
    assert got.count() == total == 5 and needed <= 5
    assert scanned(got) == 10 * needed


def test_a_long_list_of_row_groups(spark, monkeypatch):
    t, path = build(spark, n=200, epochs=1, group_rows=1, world=2)
    cols = ["rank", "pos_in_rank", "row_id", "ids"]
    want = rows(order(t, 1, 2).where("rank = 1").join(encode(t), "row_id"), cols)
    assert rows(prepared.read_store(spark, path, rank=1), cols) == want
    monkeypatch.setattr(prepared, "LISTED_GROUPS", 3)
    assert rows(prepared.read_store(spark, path, rank=1), cols) == want


def test_more_epochs_later(spark):
    t, path = build(spark, n=120, epochs=1)
    before = payload_bytes(path)
    more = order(t, 3).where("epoch > 0")
    prepared.write_locators(spark, more, path, group_rows=50, mode="append")
    assert payload_bytes(path) == before
    cols = ["epoch", "rank", "pos_in_rank", "row_id"]
    assert rows(prepared.read_store(spark, path), cols) == rows(order(t, 3), cols)
    assert rows(prepared.read_store(spark, path, epoch=2, rank=0), cols) == rows(order(t, 3).where("epoch = 2 and rank = 0"), cols)


def test_unknown_rows_and_no_rows(spark):
    t = texts(spark, 20)
    path = staging_path(spark, "store-test")
    prepared.write_payload(t, path, encode)
    with pytest.raises(Exception, match="the payload has no row"):
        prepared.write_locators(spark, order(texts(spark, 30), 1), path)
    t, path = build(spark, n=40)
    assert prepared.read_store(spark, path, epoch=9).count() == 0


def test_writing_the_payload_moves_nothing(spark):
    """The payload is written where it is read: ranges of row groups in the plan, no exchange."""
    plan = encode(texts(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    ranges = prepared._any_of(F.col("g"), [1, 2, 3, 7, 8, 20])
    df = spark.range(30).withColumnRenamed("id", "g").where(ranges)
    assert sorted(r[0] for r in df.collect()) == [1, 2, 3, 7, 8, 20]
    assert spark.range(5).withColumnRenamed("id", "g").where(prepared._any_of(F.col("g"), [])).count() == 0
