"""Null keys, non-finite numbers, hosts without data: no row gets lost."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import py_float_text
from tessera.operators import metrics as m, telemetry as tm, udf
from tessera.operators.corpus import split_lines
from tessera.operators.feed import assign_rank, shuffle_position
from tessera.operators.ordered import positions
from tests.helpers import rows


def losses(spark, values):
    return spark.createDataFrame([(1, 0, 0, "train", v) for v in values], "run_id int, rank int, epoch int, phase string, loss double")


@pytest.mark.parametrize("values,text", [
    ([math.nan, 1.0], "nan"), ([math.inf, 1.0], "inf"), ([-math.inf, 1.0], "-inf"), ([math.inf, -math.inf], "nan"),
    ([2e8, 2e8 + 1], "200000000.5"), ([1e17, 1e17], "1e+17"), ([1e300], "1e+300"), ([0.25, None], "0.25"), ([None], "None"),
    ([0.12345, 0.12345], "0.1234"), ([1e-7, 0.0], "0.0")])
def test_epoch_loss_of_any_double(spark, values, text):
    r = m.epoch_loss(losses(spark, values)).select(py_float_text("avg_loss").alias("t"), "n_steps").collect()
    assert [(x["t"], x["n_steps"]) for x in r] == [(text, len(values))]


def test_positions_with_null_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), (None, 1), (None, 2)], "k string, v int")
    want = sorted([("a", 3, 0), ("a", 4, 1), (None, 1, 0), (None, 2, 1)], key=repr)
    assert rows(positions(df, ["v"], ["k"])) == want
    assert rows(positions(df, ["v"], ["k"], bucket=F.col("v"))) == want
    x = shuffle_position(df.withColumnRenamed("v", "row_id"), partition_cols=["k"])
    assert x.count() == 4
    assert assign_rank(x.drop("n_rows"), 2, partition_cols=("k", "epoch")).count() == 4


def test_generate_checks_and_keeps_id_types(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "b")], "row_id string, source_text string").coalesce(1)

    class Model:
        def __init__(self, n):
            self.n = n

        def generate(self, texts, num_return_sequences=1):
            return [[t + "!"] * num_return_sequences for t in texts][: self.n]

    assert rows(udf.generate(df, lambda: Model(9), num_return_sequences=2)) == [
        ("x", 0, "a!"), ("x", 1, "a!"), ("y", 0, "b!"), ("y", 1, "b!")]
    with pytest.raises(Exception, match="outputs for 1 of 2 texts"):
        udf.generate(df, lambda: Model(1)).collect()


def test_metric_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "k string, v double")
    out = udf.metric(df, lambda b: {"s": float(pd.Series(b["v"]).sum())}, ["s"], lambda c: {"twice": c["s"] * 2}, ["v"], ["k"])
    assert rows(out) == sorted([("a", 1.0, 2.0), (None, 5.0, 10.0)], key=repr)


def test_accuracy_counts_missing_logits(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1), (None, 1)], "logits array<double>, label int")
    assert rows(m.argmax_accuracy(df)) == [(2, 1, 0.5)]


def test_inventory_of_a_host_without_devices(spark):
    df = spark.createDataFrame([("h", "A, 1, 5 MiB"), ("empty", ""), (None, "B, 2, 6 MiB")], "source string, line string")
    assert rows(tm.parse_inventory(df)) == sorted([
        ("h", "A", "1", "5 MiB", 1), ("empty", None, None, None, 0), (None, "B", "2", "6 MiB", 1)], key=repr)


def test_every_host_has_a_record(spark):
    versions = spark.createDataFrame([("ok", "1", "2", None), ("bad", None, None, "broken"), ("idle", "1", "2", None)],
                                     "source string, driver_version string, cuda_version string, error string")
    inventory = spark.createDataFrame([("ok", "A", "1", "5", 1)], "source string, name string, device_id string, memory string, n_devices long")
    line = "d, 2024/01/01 00:00:00.1, 1, 2, 3, 4, 5, 6"
    log = spark.createDataFrame([("ok", 0, line), ("ok", 5000, line), ("bad", 0, line), ("bad", 5000, line), ("new", 0, line)],
                                "source string, line_no long, line string")
    out = rows(tm.profile_record(versions, inventory, tm.profile_nested(tm.monitor_fields(log, "skip"))))
    assert [(s, c) for s, c, _ in out] == [("bad", 0), ("idle", 0), ("new", 0), ("ok", 0), ("ok", 1)]
    text = {(s, c): t for s, c, t in out}
    assert '"profile":{}' in text["idle", 0] and '"error":"broken"' in text["bad", 0] and "profile" not in text["bad", 0]


def test_telemetry_joins_are_not_keyed_on_the_host_alone(spark):
    log = spark.createDataFrame([("h", i, "d, 2024/01/01 00:00:00.1, 1, 2, 3, 4, 5, 6") for i in range(9)],
                                "source string, line_no long, line string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (tm.monitor_fields(log, "strict"), tm.percent_series(tm.parse_monitor(log, "skip"))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
            assert joins and all("[_k" in x for x in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_scope_over_several_columns(spark):
    df = spark.createDataFrame([(1, "train", "g", "a"), (2, "test", "g", "b\nc"), (3, "train", "g", "d\n"), (4, None, "g", "e")],
                               "doc_id long, split string, grp string, text string")
    out = split_lines(df, scope="group", group_col=["split", "grp"])
    assert rows(out) == sorted([("train", "g", 1, 0, "ad"), ("test", "g", 2, 0, "b"), ("test", "g", 2, 1, "c"), (None, "g", 4, 0, "e")], key=repr)
    with pytest.raises(ValueError, match="keep"):
        split_lines(df, scope="group", group_col="grp", keep=("split",))


def test_percent_inverse(spark):
    df = spark.createDataFrame([(25.0, 16160.0)], "p double, t double")
    out = df.select(tm.absolute_to_percent((F.col("p") / 100) * F.col("t"), F.col("t")).alias("p")).first()
    assert out["p"] == pytest.approx(25.0)


def test_a_rank_reads_its_own_folder(spark, tmp_path):
    from tessera.operators.encode import encode_pairs
    from tessera.sources import files

    texts = spark.range(40).selectExpr("id AS row_id", "concat('s', id) AS source_text", "concat('t', id) AS target_text")
    order = assign_rank(shuffle_position(texts, epochs=2), 4).select("epoch", "rank", "pos_in_rank", "row_id")
    order = order.withColumn("split", F.when(F.col("row_id") < 8, "test").otherwise("train"))
    path = str(tmp_path / "prepared")
    files.write_prepared(texts, order, path, lambda d: encode_pairs(d, keep=order.columns), split_col="split")
    part = files.read_prepared(spark, path, epoch=1, rank=2, split="train")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    want = order.where("epoch = 1 AND rank = 2 AND split = 'train'").select("pos_in_rank", "row_id")
    assert rows(part.select("pos_in_rank", "row_id")) == rows(want)
    assert files.read_prepared(spark, path).count() == order.count()


def test_decode_keeps_a_genuine_replacement_character(spark):
    from tessera.functions.tokens import BYTE_OFFSET, decode_ids

    cases = ["a�b".encode(), b"a\xffb", b"\xe4\xb8", b"x\xf0\x9f\x98\x80\xf0\x9f", b"\xc0\x80\xed\xa0\x80z", "é中\n".encode(), b""]
    df = spark.createDataFrame([(i, [b + BYTE_OFFSET for b in c]) for i, c in enumerate(cases)], "i int, ids array<int>")
    got = {r["i"]: r["t"] for r in df.select("i", decode_ids("ids", clean_spaces=False).alias("t")).collect()}
    assert got == {i: c.decode("utf-8", errors="ignore") for i, c in enumerate(cases)}


def test_one_pass_over_the_steps(spark):
    from tessera.plans.queries import QUERIES
    from tests.conftest import SF_SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["loss_across_ranks"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") + plan.count("BatchScan") <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reading_one_host_scans_its_folder_only(spark, tmp_path):
    from tessera.sources import files

    log = spark.createDataFrame([(h, i, f"{h} {i}") for h in ("rack:1", "rack 2", "c") for i in range(30)],
                                "source string, line_no long, line string")
    path = str(tmp_path / "log")
    files.write_text_log(log, path)
    whole = files.read_text_lines(spark, path, source="source")
    assert rows(whole.select("source", "line_no", "line")) == rows(log)
    one = files.read_text_lines(spark, path, source="source", only=["rack:1"], materialize=False)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source" in plan or "PartitionFilters: [isnotnull(source" in plan
    assert rows(one.select("source", "line_no", "line")) == rows(log.where("source = 'rack:1'"))


def test_stream_hosts_are_named_as_in_the_batch(spark, tmp_path):
    from tessera.sources import files
    from tessera.streaming import streams

    log = spark.createDataFrame([(h, i, "d, 2024/01/01 00:00:00.1, 1, 2, 3, 4, 5, 6") for h in ("rack:1", "rack 2") for i in range(3)],
                                "source string, line_no long, line string")
    path, out, ck = (str(tmp_path / n) for n in ("log", "out", "ck"))
    files.write_text_log(log, path)
    lines = streams.read_text_stream(spark, path, source_key="source")
    streams.run_to_table(streams.device_max_stream(lines), out, ck)
    got = streams.latest(spark, out, ["window_start", "window_end", "source", "device"])
    assert sorted(r["source"] for r in got.collect()) == ["rack 2", "rack:1"]
