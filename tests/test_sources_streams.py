"""S1-S3, S7, S8 and the streams (T1, T2), including a late row."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.plans import queries as q
from tessera.session import staging_path
from tessera.sources import files
from tessera.streaming import streams
from tests.helpers import rows


def test_csv_roundtrip_keeps_hard_text(spark):
    data = [(1, 'a "quoted", text', "line1\nline2"), (2, "  leading and trailing  ", ""),
            (3, "comma, and\r\nCRLF", "é中😀")]
    df = spark.createDataFrame(data, "row_id long, source_text string, target_text string")
    path = staging_path(spark, "csv-test")
    files.write_pairs_csv(df, path)
    back = files.read_pairs_csv(spark, path, schema=q.PAIR_ROW_SCHEMA)
    # an empty cell reads back as null, as a pandas CSV reader gives NaN
    want = [(i, s, t if t != "" else None) for i, s, t in data]
    assert rows(back) == sorted(want, key=repr)


def test_split_corpus_from_parquet_folders(spark):
    path = staging_path(spark, "splits")
    df = spark.createDataFrame([(1, "train", "a"), (2, "validation", "b"), (3, "test", "c")],
                               "doc_id long, split string, text string")
    df.write.partitionBy("split").parquet(path)
    back = files.read_split_corpus(spark, path)
    assert rows(back, ["doc_id", "split", "text"]) == rows(df, ["doc_id", "split", "text"])


def test_json_sink(spark):
    path = staging_path(spark, "json")
    df = spark.createDataFrame([("h", 0, '{"a":1}')], "source string, chunk long, profile_json string")
    files.write_json(df, path)
    assert spark.read.json(path).count() == 1


def _step_rows(spark, data):
    return spark.createDataFrame(data, streams.STEP_SCHEMA)


def test_stream_drops_a_late_row(spark):
    src = staging_path(spark, "stream-src")
    out, ck = staging_path(spark, "stream-out"), staging_path(spark, "stream-ck")
    from datetime import datetime
    first = [(0, 0, 0, i, "train", 1.0, datetime(2024, 1, 1, 10, i)) for i in range(3)]
    _step_rows(spark, first).write.mode("append").parquet(src)
    steps = lambda: spark.readStream.schema(streams.STEP_SCHEMA).parquet(src)
    streams.run_to_table(streams.step_loss_stream(steps(), "1 hour", "10 minutes"), out, ck)
    late = [(0, 0, 0, 9, "train", 100.0, datetime(2024, 1, 1, 8, 0)),   # two hours behind: dropped
            (0, 0, 0, 10, "train", 3.0, datetime(2024, 1, 1, 10, 30))]
    _step_rows(spark, late).write.mode("append").parquet(src)
    streams.run_to_table(streams.step_loss_stream(steps(), "1 hour", "10 minutes"), out, ck)
    res = streams.latest(spark, out, ["window_start", "window_end", "run_id", "phase", "epoch"]).collect()
    assert len(res) == 1
    assert res[0].n == 4 and res[0].mean_loss == 1.5


def test_stream_equals_batch(spark):
    from tests.conftest import SF_SMALL
    from tessera.operators import telemetry as tm
    from tessera.plans import fixtures as fx
    s = q.stream_device_max(spark, SF_SMALL)
    parsed = tm.parse_monitor(fx.monitor_log(spark, SF_SMALL), mode="skip").where(F.col("ts").isNotNull())
    b = (parsed.groupBy(F.window("ts", q.STREAM_WINDOW).alias("w"), "source", "device")
         .agg(F.max("gpu_utilization").alias("max_gpu"), F.max("gpu_memory_used").alias("max_gpu_memory"),
              F.max("cpu_utilization").alias("max_cpu"), F.max("ram_used").alias("max_ram"))
         .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "device",
                 "max_gpu", "max_gpu_memory", "max_cpu", "max_ram"))
    assert rows(s, sorted(s.columns)) == rows(b, sorted(s.columns))


def test_text_log_stream_equals_batch(spark):
    from tessera.operators import telemetry as tm
    d = staging_path(spark, "log-files")
    os.makedirs(d, exist_ok=True)
    good = "d{dev}, 2024/01/01 00:{m:02d}:00.5, {g}, 10, 100, 1.5, 20, 40"
    for f in range(2):
        with open(os.path.join(d, f"h{f}.log"), "w") as fh:
            fh.write("\n".join(good.format(dev=f, m=m, g=(m * 7) % 100) for m in range(30)) + "\nbad line\n")
    out, ck = staging_path(spark, "log-out"), staging_path(spark, "log-ck")
    streams.run_to_table(streams.device_max_stream(streams.read_text_stream(spark, d), "10 minutes", "1 hour"), out, ck)
    got = streams.latest(spark, out, ["window_start", "window_end", "source", "device"])
    batch = tm.parse_monitor(files.read_text_lines(spark, d), mode="skip")
    want = (batch.groupBy(F.window("ts", "10 minutes").alias("w"), "source", "device")
            .agg(F.max("gpu_utilization").alias("max_gpu"))
            .select(F.col("w.start").alias("window_start"), "source", "device", "max_gpu"))
    assert rows(got, ["window_start", "source", "device", "max_gpu"]) == rows(want)
    assert len(rows(want)) == 6


def test_csv_columns_by_header_name(spark):
    d = staging_path(spark, "csv-extra")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "train.csv"), "w") as fh:
        fh.write('id,target_text,note,source_text\n1,"t, one","x","s\n1"\n2,t2,,s2\n')
    df = files.read_pairs_csv(spark, d, keep=("id",))
    assert df.columns == ["source_text", "target_text", "id"]
    assert sorted(tuple(r) for r in df.collect()) == [("s\n1", "t, one", "1"), ("s2", "t2", "2")]
    import pytest
    with pytest.raises(ValueError):
        files.read_pairs_csv(spark, d, columns=("source_text", "missing"))


def test_text_log_numbered_across_files(spark):
    """S4 with one log spread over several files per host: numbering runs on
    across the files in name order, and equals the original line numbers."""
    import glob

    from tessera.plans import fixtures as fx
    from tests.conftest import SF_SMALL

    log = fx.monitor_log(spark, SF_SMALL)
    path = staging_path(spark, "text-log")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        files.write_text_log(log, path)
    finally:
        spark.conf.set(key, old)
    per_host = [len(glob.glob(d + "/part-*")) for d in glob.glob(path.replace("file:", "") + "/source=*")]
    assert len(per_host) == 3 and min(per_host) > 1
    back = files.read_text_lines(spark, path, source="source")
    assert rows(back, ["source", "line_no", "line"]) == rows(log, ["source", "line_no", "line"])


def test_split_corpus_from_text_folders(spark):
    """S3, text form: one document per file, the split from its folder."""
    root = staging_path(spark, "split-text").replace("file:", "")
    docs = {"train": ["one\ntwo", "three"], "validation": ["four\n"]}
    for split, texts in docs.items():
        os.makedirs(f"{root}/{split}")
        for i, t in enumerate(texts):
            with open(f"{root}/{split}/doc{i}.txt", "w", encoding="utf-8") as fh:
                fh.write(t)
    back = files.read_split_corpus(spark, root, fmt="text")
    assert rows(back, ["split", "text"]) == sorted(
        [(s, t) for s, ts in docs.items() for t in ts], key=repr)


def test_banner_file_is_one_record(spark):
    """A captured banner of several lines is one text per file."""
    from tessera.operators import telemetry as tm

    root = staging_path(spark, "banner-file").replace("file:", "")
    os.makedirs(f"{root}/source=h0")
    with open(f"{root}/source=h0/banner.txt", "w", encoding="utf-8") as fh:
        fh.write("+-----+\n| NVIDIA-SMI 470.57.02    Driver Version: 470.57.02    CUDA Version: 11.4     |\n"
                 "|-----+\n")
    b = files.read_banners(spark, root, source="source")
    v = tm.parse_versions(b).collect()
    assert len(v) == 1 and (v[0].driver_version, v[0].cuda_version, v[0].error) == ("470.57.02", "11.4", None)
