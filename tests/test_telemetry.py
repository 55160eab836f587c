"""P6, P7, W5, H12-H19, S4-S6 on small inline logs and files."""

import os
import tempfile

from tessera.operators import telemetry as tm
from tessera.sources import files
from tests.helpers import rows

GOOD = "0000:01.0, 2024/01/01 00:00:0{s}.123, 10, 100, 1000, 5.5, 200, 400"


def log_df(spark, lines, source="h"):
    return spark.createDataFrame([(source, i, x) for i, x in enumerate(lines)], "source string, line_no long, line string")


def test_strict_cut_at_first_malformed_middle_line(spark):
    lines = [GOOD.format(s=0), GOOD.format(s=1), "garbage", GOOD.format(s=3)]
    assert [r.line_no for r in tm.parse_monitor(log_df(spark, lines), "strict").collect()] == [0, 1]
    assert sorted(r.line_no for r in tm.parse_monitor(log_df(spark, lines), "skip").collect()) == [0, 1, 3]


def test_malformed_first_and_last_line(spark):
    first = ["x, y", GOOD.format(s=1)]
    last = [GOOD.format(s=0), "0000:01.0, 2024/0"]
    assert tm.parse_monitor(log_df(spark, first), "strict").count() == 0
    assert tm.parse_monitor(log_df(spark, last), "strict").count() == 1


def test_backfill_gives_host_fields_to_the_tick(spark):
    lines = ["d1, 2024/01/01 00:00:00.1, 1, 2, 3", "d2, 2024/01/01 00:00:00.2, 4, 5, 6, 7.5, 8, 9",
             "d1, 2024/01/01 00:00:01.1, 1, 2, 3"]
    out = {r.line_no: r for r in tm.parse_monitor(log_df(spark, lines), "backfill").collect()}
    assert (out[0].cpu_utilization, out[0].ram_used, out[0].ram_total) == (7.5, 8.0, 9.0)
    assert out[2].cpu_utilization is None           # no closing eight-field line
    assert tm.parse_monitor(log_df(spark, lines), "strict").count() == 0


def test_non_numeric_and_zero_total(spark):
    lines = ["d, 2024/01/01 00:00:00.5, [N/A], 10, 0, 1.0, 5, 0"]
    p = tm.parse_monitor(log_df(spark, lines), "skip")
    r = p.collect()[0]
    assert r.gpu_utilization is None and r.gpu_memory_total == 0.0
    s = tm.percent_series(p).collect()[0]
    assert s.gpu_memory_pct is None and s.ram_pct is None and s.seconds_since_start == 0.0


def test_report_formats(spark):
    lines = [GOOD.format(s=0), "0000:01.0, 2024/01/01 00:00:01.1, 99.96, 1234.9, 2000, 7.25, 300.7, 400"]
    r = tm.device_report(tm.parse_monitor(log_df(spark, lines), "skip")).collect()[0]
    assert r.max_gpu_text == "%2.1f%%" % 99.96
    assert r.max_gpu_memory_text == "%dMB" % 1234.9
    assert r.max_ram_text == "%dMB" % 300.7


def test_first_values_follow_log_order(spark):
    lines = ["d, 2024/01/01 00:00:05.0, 1, 10, 300, 1, 1, 700",
             "d, 2024/01/01 00:00:01.0, 1, 10, 100, 1, 1, 500"]
    s = {r.line_no: r for r in tm.percent_series(tm.parse_monitor(log_df(spark, lines), "skip")).collect()}
    assert s[1].seconds_since_start == -4.0
    assert s[1].gpu_memory_mb == (10 * 100.0 / 100 / 100.0) * 300


def test_inventory_and_banners(spark):
    inv = spark.createDataFrame([("h", "Tesla T4 , 00000000:00:1E.0,  15360 MiB"),
                                 ("h", "A100, 00000000:00:1F.0, 40536 MiB, extra")], "source string, line string")
    got = rows(tm.parse_inventory(inv), ["name", "device_id", "memory", "n_devices"])
    assert got == [("A100", "00000000:00:1F.0", "40536 MiB", 2), ("Tesla T4", "00000000:00:1E.0", "15360 MiB", 2)]
    banners = spark.createDataFrame([
        ("a", "| NVIDIA-SMI 470.57.02    Driver Version: 470.57.02    CUDA Version: 11.4     |"),
        ("b", "NVIDIA-SMI has failed")], "source string, text string")
    v = {r.source: r for r in tm.parse_versions(banners).collect()}
    assert (v["a"].driver_version, v["a"].cuda_version, v["a"].error) == ("470.57.02", "11.4", None)
    assert v["b"].driver_version is None and v["b"].error == "nvidia-smi output is unexpected"


def test_text_lines_numbered_across_blocks(spark):
    d = tempfile.mkdtemp(prefix="tessera-log-")
    lines = [f"line {i}" for i in range(3000)]
    with open(os.path.join(d, "a.log"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(os.path.join(d, "b.log"), "w") as fh:
        fh.write("x\r\ny\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_text_lines(spark, d)
        got = {(os.path.basename(r.source), r.line_no): r.line for r in df.collect()}
        assert spark.read.text(d).rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(got[("a.log", i)] == x for i, x in enumerate(lines))
    assert got[("b.log", 0)] == "x\r" and got[("b.log", 1)] == "y"


def test_profile_json_chunks(spark):
    lines = [GOOD.format(s=i % 10) for i in range(7)]
    nested = tm.profile_nested(tm.monitor_fields(log_df(spark, lines), "skip"), chunk=3)
    js = sorted((r.chunk, r.profile_json) for r in tm.profile_json(nested).collect())
    assert [c for c, _ in js] == [0, 1, 2]
    assert js[0][1].startswith('{"0000:01.0":{"timestamp":["2024/01/01 00:00:00"')


def py_read_monitor(lines):
    """The strict reader restated: keep lines while they have eight fields."""
    kept = []
    for i, line in enumerate(lines):
        fields = [f.strip() for f in line.split(",")]
        if len(fields) != 8:
            break
        kept.append((i, fields[0], fields[1].split(".")[0]))
    return kept


from hypothesis import given, settings, strategies as st  # noqa: E402

LINE = st.sampled_from([
    GOOD.format(s=1), GOOD.format(s=2), "d, 2024/01/01 00:00:03, 1, 2, 3", "",
    " d2 , 2024/01/01 00:00:04.9 , 1, 2, 3, 4, 5, 6 ", "a,b,c,d,e,f,g,h", "x, y, z, 1, 2, 3, 4, 5, 6"])


@settings(max_examples=15, deadline=None)
@given(st.lists(LINE, min_size=0, max_size=12))
def test_strict_mode_equals_python_reader(spark, lines):
    if not lines:
        return
    got = sorted((r.line_no, r.device, r.timestamp) for r in tm.monitor_fields(log_df(spark, lines), "strict").collect())
    assert got == py_read_monitor(lines)
