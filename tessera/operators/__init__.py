"""DataFrame -> DataFrame operators (chain them with ``DataFrame.transform``)."""

from tessera.operators.corpus import select_splits, split_lines
from tessera.operators.encode import decode, encode_causal, encode_pairs
from tessera.operators.feed import assign_batch, assign_rank, collect_batches, shuffle_position
from tessera.operators.metrics import (
    argmax_accuracy, checkpoint_names, early_stop, epoch_loss, epoch_monitor, loss_across_ranks,
    run_elapsed, thin_steps,
)
from tessera.operators.ordered import carry, positions
from tessera.operators.telemetry import (
    device_max, device_report, first_values, monitor_fields, parse_inventory, parse_monitor,
    parse_versions, percent_series, profile_json, profile_nested, profile_record,
)
from tessera.operators.udf import chain, encode_with_tokenizer, generate, map_batches, metric

__all__ = [
    "select_splits", "split_lines", "decode", "encode_causal", "encode_pairs",
    "assign_batch", "assign_rank", "collect_batches", "shuffle_position",
    "argmax_accuracy", "checkpoint_names", "early_stop", "epoch_loss", "epoch_monitor",
    "loss_across_ranks", "run_elapsed", "thin_steps", "carry", "positions",
    "device_max", "device_report", "first_values", "monitor_fields", "parse_inventory",
    "parse_monitor", "parse_versions", "percent_series", "profile_json", "profile_nested",
    "profile_record", "chain", "encode_with_tokenizer", "generate", "map_batches", "metric",
]
