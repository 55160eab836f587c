"""Training-run analytics.

Step metrics are small next to the corpus, but the operators still avoid
single-task plans: aggregations are partial/final, and the only windows run
over already aggregated rows per run (one row per epoch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.numeric import (
    argmax, exact_mean_rounded, format_minutes, py_float_text, round_half_even)
from tessera.operators.ordered import carry


def epoch_loss(df: DataFrame, keys: Sequence[str] = ("run_id", "rank", "epoch", "phase"),
               loss: str = "loss") -> DataFrame:
    """A2/A3: unweighted mean of the step losses of one rank and epoch,
    rounded half-even to 4 places (Q6: every rank has its own value).  The
    mean is exact (see ``exact_mean_rounded``), so a mean on a rounding tie
    rounds to even whatever the partitioning."""
    return df.groupBy(*keys).agg(
        exact_mean_rounded(loss, 4).alias("avg_loss"),
        F.count(F.lit(1)).alias("n_steps"))


def thin_steps(df: DataFrame, every_n: int, step: str = "step") -> DataFrame:
    """Keep every n-th step (the logger writes when ``(step + 1) % n == 0``)."""
    return df.where(thinned(step, every_n))


def thinned(step: str, every_n: int):
    """P9 as a condition."""
    return F.coalesce((F.col(step) + 1) % every_n == 0, F.lit(False))


def loss_across_ranks(df: DataFrame, every_n: int = 10, run: str = "run_id",
                      loss: str = "loss", places: int = 12) -> DataFrame:
    """A4 + P9: cross-rank mean per logged step, and per epoch.

    Step level: mean over ranks of the loss at each step; train steps are
    thinned to every ``every_n``-th (the filter runs before the shuffle).
    Epoch level: every rank's mean over its steps, then the mean over
    ranks, as a synchronised epoch metric is reduced.  Output
    ``(run_id, phase, epoch, level, step, mean_loss, n)``, ``step`` null on
    epoch rows.
    """
    # every row counts for its epoch, and for its step if that is logged: one
    # pass over the input serves both levels
    step_row = F.struct(F.lit("step").alias("level"), F.col("step").cast("bigint").alias("step"))
    epoch_row = F.struct(F.lit("epoch").alias("level"), F.lit(None).cast("bigint").alias("step"))
    logged = thinned("step", every_n) | F.coalesce(F.col("phase") != "train", F.lit(True))
    rows = df.select(run, "phase", "epoch", "rank", F.col(loss).alias("_x"),
                     F.explode(F.when(logged, F.array(step_row, epoch_row)).otherwise(F.array(epoch_row))).alias("_l"))
    rows = rows.select(run, "phase", "epoch", "rank", "_x", "_l.level", "_l.step")
    per_rank = rows.groupBy(run, "phase", "epoch", "level", "step", "rank").agg(
        F.sum("_x").alias("_s"), F.count("_x").alias("_c"), F.count(F.lit(1)).alias("_n"))
    mean = F.when(F.col("level") == "step", F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))).otherwise(
        F.avg(F.col("_s") / F.nullif(F.col("_c"), F.lit(0))))
    out = per_rank.groupBy(run, "phase", "epoch", "level", "step").agg(
        round_half_even(mean, places).alias("mean_loss"),
        F.when(F.col("level") == "step", F.sum("_n")).otherwise(F.count(F.lit(1))).alias("n"))
    return out.select(run, "phase", "epoch", "level", "step", "mean_loss", "n")


def epoch_monitor(df: DataFrame, phase: str = "val", run: str = "run_id", loss: str = "loss") -> DataFrame:
    """The value an epoch-level monitor sees: mean over ranks of each rank's
    mean ``loss`` in ``phase``.  Output ``(run_id, epoch, value)``."""
    per_rank = df.where(F.col("phase") == phase).groupBy(run, "epoch", "rank").agg(F.avg(loss).alias("_m"))
    return per_rank.groupBy(run, "epoch").agg(F.avg("_m").alias("value"))


def early_stop(values: DataFrame, patience: int, run: str = "run_id", epoch: str = "epoch",
               value: str = "value", places: int = 12) -> DataFrame:
    """The epoch at which training stops, per run.

    Mode ``min`` with ``min_delta = 0``: a value improves when it is strictly
    lower than every earlier value.  Training stops at the first check where
    the number of checks since the last improvement reaches ``patience``,
    or at once on a non-finite value.  ``patience = 0`` turns the rule off
    (``stop_epoch`` null).  Output ``(run_id, stop_epoch, best_epoch,
    best_value, n_epochs)``.
    """
    w = Window.partitionBy(run).orderBy(epoch)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(value)
    finite = ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))) & v.isNotNull()
    x = values.withColumn("_i", F.row_number().over(w))
    x = x.withColumn("_prev", F.min(F.when(finite, v)).over(before))
    x = x.withColumn("_imp", finite & (F.col("_prev").isNull() | (v < F.col("_prev"))))
    x = x.withColumn("_last", F.max(F.when(F.col("_imp"), F.col("_i"))).over(upto))
    stop = ~finite
    if patience > 0:
        stop = stop | ((F.col("_i") - F.coalesce(F.col("_last"), F.lit(0))) >= patience)
    else:
        stop = F.lit(False)
    whole = Window.partitionBy(run)
    x = x.withColumn("_stop", stop).withColumn(
        "_si", F.min(F.when(F.col("_stop"), F.col("_i"))).over(whole)).withColumn(
        "_n", F.count(F.lit(1)).over(whole))
    kept = x.where(F.col("_si").isNull() | (F.col("_i") <= F.col("_si")))
    imp_i = F.when(F.col("_imp"), F.col("_i"))
    return kept.groupBy(run).agg(
        F.max(F.when(F.col("_i") == F.col("_si"), F.col(epoch))).alias("stop_epoch"),
        F.max_by(F.col(epoch), imp_i).alias("best_epoch"),
        round_half_even(F.max_by(v, imp_i), places).alias("best_value"),
        F.max("_n").cast("bigint").alias("n_epochs"))


def checkpoint_names(df: DataFrame, output_dir: str = "outputs", prefix: str = "T5",
                     max_epochs: int | None = None, save_only_last_epoch: bool = False,
                     run: str = "run_id") -> DataFrame:
    """H21 + P8: the folder name written at the end of each training epoch
    of each rank: ``{dir}/{prefix}-epoch-{e}-train-loss-{t}-val-loss-{v}``.

    ``t`` is the rank's rounded train mean of that epoch; ``v`` the rank's
    most recent rounded validation mean (``None`` before any).  With
    ``save_only_last_epoch`` only epoch ``max_epochs - 1`` is kept.
    """
    per = df.groupBy(run, "rank", "epoch").agg(
        exact_mean_rounded(F.when(F.col("phase") == "train", F.col("loss")), 4).alias("_t"),
        exact_mean_rounded(F.when(F.col("phase") == "val", F.col("loss")), 4).alias("_v"),
        F.count(F.when(F.col("phase") == "train", 1)).alias("_nt"))
    per = carry(per, "_v", "_vc", [run, "rank"], "epoch", direction="forward", inclusive=True, chunk=1 << 12)
    per = per.where(F.col("_nt") > 0)
    if save_only_last_epoch:
        if max_epochs is None:
            raise ValueError("save_only_last_epoch needs max_epochs")
        per = per.where(F.col("epoch") == max_epochs - 1)
    name = F.concat(
        F.lit(f"{output_dir}/{prefix}-epoch-"), F.col("epoch").cast("string"),
        F.lit("-train-loss-"), py_float_text("_t"),
        F.lit("-val-loss-"), py_float_text("_vc"))
    return per.select(run, "rank", "epoch", name.alias("checkpoint"))


def argmax_accuracy(df: DataFrame, logits: str = "logits", label: str = "label",
                    keys: Sequence[str] = (), ignore_index: int | None = None) -> DataFrame:
    """A10: share of positions whose argmax equals the label.  No shift and
    no mask unless ``ignore_index`` is given."""
    x = df
    if ignore_index is not None:
        x = x.where(F.col(label) != ignore_index)
    # no logits or no label: counted, and not a hit
    hit = F.coalesce(argmax(logits) == F.col(label), F.lit(False)).cast("int")
    return x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.sum(hit).cast("bigint").alias("n_correct"),
        F.avg(hit.cast("double")).alias("accuracy"))


def run_elapsed(df: DataFrame, keys: Sequence[str] = ("run_id",), ts: str = "ts") -> DataFrame:
    """First and last timestamp of a run and the elapsed time."""
    agg = df.groupBy(*keys).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))
    sec = (F.unix_micros(F.col("end_ts").cast("timestamp"))
           - F.unix_micros(F.col("start_ts").cast("timestamp"))) / F.lit(1e6)
    return agg.withColumn("elapsed_sec", sec).withColumn("elapsed_text", format_minutes("elapsed_sec"))
