"""Plan shape: native queries stay in the JVM, filters and projections
reach the scan, and no big step runs in a single partition."""

import pytest

from tessera.plans.queries import QUERIES
from tests.conftest import SF_SMALL

NATIVE = ["corpus_lines_document", "corpus_lines_group", "causal_encode", "pair_encode", "pair_encode_left",
          "decode_roundtrip", "corpus_chain_splits", "shuffle_epoch", "rank_shards", "rank_batches",
          "epoch_loss_by_rank", "loss_across_ranks", "early_stop", "checkpoint_names", "checkpoint_last_epoch", "argmax_accuracy",
          "run_elapsed", "monitor_parse_strict", "monitor_parse_skip", "monitor_parse_backfill",
          "device_max_report", "device_percent_series", "device_profile_nested", "device_profile_record",
          "device_inventory",
          "driver_versions"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan_has_no_python(spark, name):
    p = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "MapInPandas" not in p


# one-row results: only one partial row per partition reaches the final merge
GLOBAL_AGGREGATES = {"argmax_accuracy"}


@pytest.mark.parametrize("name", [n for n in NATIVE if n not in GLOBAL_AGGREGATES])
def test_no_single_partition_exchange(spark, name):
    p = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in p


def test_scan_is_pruned(spark):
    p = plan_text(QUERIES["corpus_lines_document"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    p = plan_text(QUERIES["pair_encode"](spark, SF_SMALL))
    assert "PushedFilters" in p and "role" in p


def test_global_aggregate_is_partial_first(spark):
    p = plan_text(QUERIES["argmax_accuracy"](spark, SF_SMALL))
    assert p.count("HashAggregate") >= 2 and "partial_" in p
