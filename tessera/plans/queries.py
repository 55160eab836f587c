"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the fixtures) and runs over
them whole.  Column names match the oracle SQL in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.functions.numeric import argmax, round_half_even
from tessera.operators.corpus import select_splits, split_lines
from tessera.operators.encode import decode, encode_causal, encode_pairs
from tessera.operators.feed import assign_batch, assign_rank, collect_batches, shuffle_position
from tessera.operators import metrics as m
from tessera.operators import dictionary, exact, permute, states
from tessera.operators import telemetry as tm
from tessera.operators import udf
from tessera.plans import fixtures as fx
from tessera.plans import standins
from tessera.session import staging_path
from tessera.sources import files, growing, prepared
from tessera.streaming import stateful, streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# parameters shared with the oracle SQL
CORPUS_LENGTH = 512
PAIR_LENGTH = 256
EPOCHS = 3
SEED = 84
WORLD = 8            # nodes x devices per node
DEVICES_PER_NODE = 4
BATCH = 6
EVERY_N = 10
PATIENCE = 2
MAX_EPOCHS = 6
PROFILE_CHUNK = 4096
LONGEST = 1 << 20
BROKEN_BLANK = ' "q",\n'
PAIR_ROW_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("source_text", T.StringType()),
    T.StructField("target_text", T.StringType()),
])


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- step 1: corpus lines -------------------------------------------------

@query
def corpus_lines_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_lines(fx.corpus(spark, sf_dir), scope="document")


@query
def corpus_lines_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: texts concatenated per split and source, so that no line runs from
    one split into another."""
    return split_lines(fx.corpus(spark, sf_dir), scope="group", group_col=["split", "grp"], order_col="doc_id",
                       dense_order=True)


# ---- step 2: encoding -----------------------------------------------------

@query
def causal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = split_lines(fx.corpus(spark, sf_dir), scope="document")
    return encode_causal(lines, max_length=CORPUS_LENGTH, preset="causal_copy", keep=("doc_id", "line_no"))


@query
def pair_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pairs(fx.pairs(spark, sf_dir), source_max_length=PAIR_LENGTH,
                        target_max_length=PAIR_LENGTH, preset="seq2seq")


@query
def pair_encode_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pairs(fx.pairs(spark, sf_dir), source_max_length=PAIR_LENGTH,
                        target_max_length=PAIR_LENGTH, preset="causal_left")


@query
def decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = encode_pairs(fx.pairs(spark, sf_dir), source_max_length=PAIR_LENGTH,
                       target_max_length=PAIR_LENGTH, preset="seq2seq")
    out = decode(enc, "source_text_input_ids", "source_decoded")
    out = decode(out, "labels", "target_decoded")
    return out.select("row_id", "source_decoded", "target_decoded")


@query
def corpus_chain_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P3 + U3 + A9: the train/evaluation splits through the chain
    split-lines -> encode, counted per split."""
    chain = (
        fx.corpus(spark, sf_dir)
        .transform(select_splits)
        .transform(lambda d: split_lines(d, scope="document", keep=("split",)))
        .transform(lambda d: encode_causal(d, max_length=CORPUS_LENGTH, keep=("split",)))
    )
    return chain.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.size(F.array_remove("attention_mask", 0))).cast("bigint").alias("n_tokens"))


# ---- step 3: feeding ------------------------------------------------------

@query
def shuffle_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_position(fx.pairs(spark, sf_dir), epochs=EPOCHS, seed=SEED).drop("n_rows")


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_rank(shuffle_position(fx.pairs(spark, sf_dir), epochs=EPOCHS, seed=SEED),
                       world_size=WORLD, devices_per_node=DEVICES_PER_NODE)


@query
def rank_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)


@query
def rank_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect_batches(assign_batch(_ranked(spark, sf_dir), BATCH))


@query
def shuffle_permuted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + W4 by a keyed permutation of the rows' ordinals, and back from the
    place to the row."""
    pairs = fx.pairs(spark, sf_dir)
    n = pairs.count()
    rows = permute.epoch_orders(permute.ordinals(pairs), n, EPOCHS, SEED)
    back = F.lit(None).cast("bigint")
    for e in range(EPOCHS):
        back = F.when(F.col("epoch") == e, permute.permuted(F.col("pos"), n, SEED, e, inverse=True)).otherwise(back)
    return rows.select("epoch", "row_id", "ordinal", "pos", back.alias("row_at_pos"))


# ---- step 4: run metrics --------------------------------------------------

@query
def epoch_loss_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.epoch_loss(fx.step_metrics(spark, sf_dir))


@query
def epoch_loss_diverged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/A3 on a run with NaN, infinite and very large losses, as text."""
    e = m.epoch_loss(fx.diverged_metrics(spark, sf_dir))
    return e.select("run_id", "rank", "epoch", "phase", m.py_float_text("avg_loss").alias("avg_loss_text"), "n_steps")


@query
def epoch_loss_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/A3 where losses of every size meet: each epoch also has 2^900, its
    negative and a few around 2^-900, and the small losses still count fully."""
    return exact.exact_mean(fx.steps_of_all_sizes(spark, sf_dir), ["run_id", "rank", "epoch", "phase"], "loss",
                            name="avg_loss", count="n_steps")


@query
def shuffle_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 within a key that is null for a part of the rows."""
    pairs = fx.pairs(spark, sf_dir).withColumn(
        "split", F.when(F.col("row_id") % 3 != 0, (F.col("row_id") % 3).cast("string")))
    return shuffle_position(pairs, epochs=1, seed=SEED, partition_cols=["split"])


@query
def profile_records_all_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with a log, with a failing banner, and with no log at all."""
    log = fx.monitor_log(spark, sf_dir)
    fields = tm.monitor_fields(log, mode="skip").where(F.col("source") != "host1")
    return tm.profile_record(tm.parse_versions(fx.driver_banners(spark, sf_dir, log)),
                             tm.parse_inventory(fx.inventory_lines(spark, sf_dir, log)),
                             tm.profile_nested(fields, chunk=PROFILE_CHUNK))


@query
def loss_across_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.loss_across_ranks(fx.step_metrics(spark, sf_dir), every_n=EVERY_N)


@query
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.early_stop(m.epoch_monitor(fx.step_metrics(spark, sf_dir)), patience=PATIENCE)


@query
def checkpoint_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.checkpoint_names(fx.step_metrics(spark, sf_dir), max_epochs=MAX_EPOCHS)


@query
def checkpoint_last_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H21 + P8: only the last epoch's checkpoint is kept, with the causal
    pipeline's name prefix."""
    return m.checkpoint_names(fx.step_metrics(spark, sf_dir), prefix="Mistral", max_epochs=MAX_EPOCHS,
                              save_only_last_epoch=True)


@query
def argmax_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.argmax_accuracy(fx.logits(spark, sf_dir))


@query
def run_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_elapsed(fx.step_metrics(spark, sf_dir))


# ---- step 5: device telemetry ---------------------------------------------

@query
def monitor_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="strict")


@query
def monitor_parse_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="skip")


@query
def monitor_parse_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="backfill")


@query
def device_max_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.device_report(tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="skip"))


@query
def device_percent_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.percent_series(tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="skip"))


@query
def device_percent_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second axis and its inverse, which leads back to the percentage."""
    parsed = tm.parse_monitor(fx.monitor_log(spark, sf_dir), mode="skip")
    series = tm.percent_series(parsed, totals=True)
    back = {c: round_half_even(tm.absolute_to_percent(F.col(f"{c}_mb"), F.col(total)), 11) for c, total in (
        ("gpu_memory", "first_gpu_memory_total"), ("ram", "first_ram_total"))}
    return series.select("source", "device", "line_no", *[v.alias(f"{c}_pct_back") for c, v in back.items()])


@query
def device_profile_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = tm.monitor_fields(fx.monitor_log(spark, sf_dir), mode="skip")
    return tm.profile_json(tm.profile_nested(fields, chunk=PROFILE_CHUNK))


@query
def device_profile_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.monitor_log(spark, sf_dir)
    fields = tm.monitor_fields(log, mode="skip")
    return tm.profile_record(tm.parse_versions(fx.driver_banners(spark, sf_dir, log)),
                             tm.parse_inventory(fx.inventory_lines(spark, sf_dir, log)),
                             tm.profile_nested(fields, chunk=PROFILE_CHUNK))


@query
def profile_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile records written through the JSON sink and read back
    with an explicit schema (no inference pass)."""
    path = staging_path(spark, "profile-json")
    files.write_json(device_profile_record(spark, sf_dir), path)
    return spark.read.schema("source string, chunk long, record_json string").json(path)


@query
def profile_variant_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + D13 as VARIANT: records of both shapes in one column, fields of sound
    and failing hosts read back by their paths."""
    path = staging_path(spark, "profile-variant")
    files.write_variant(device_profile_record(spark, sf_dir), path, "record_json")
    return files.read_variant(spark, path, {
        "error": ("$.error", "string"), "driver_version": ("$.driver_version", "string"),
        "cuda_version": ("$.cuda_version", "string"), "first_device": ("$.devices[0].device_id", "string"),
        "first_memory": ("$.devices[0].memory", "string"), "second_device": ("$.devices[1].device_id", "string")},
        keep=("source", "chunk"))


@query
def device_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.parse_inventory(fx.inventory_lines(spark, sf_dir))


@query
def driver_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.parse_versions(fx.driver_banners(spark, sf_dir))


# ---- step 6: user functions -----------------------------------------------

@query
def batch_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return udf.map_batches(fx.corpus(spark, sf_dir).select("doc_id", "text"), standins.python_split_lines,
                           "doc_id long, line_no long, text string")


@query
def user_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = udf.encode_with_tokenizer(
        fx.pairs(spark, sf_dir), standins.ByteTokenizer,
        {"source_text": PAIR_LENGTH, "target_text": PAIR_LENGTH}, keep=("row_id",),
        labels={"target_text": "mask_zero"})
    return enc.select("row_id", "source_text_input_ids", "source_text_attention_mask", "labels",
                      F.col("target_text_attention_mask").alias("labels_attention_mask"))


@query
def user_tokenizer_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = encode_pairs(fx.pairs(spark, sf_dir), source_max_length=PAIR_LENGTH, target_max_length=PAIR_LENGTH)
    return udf.decode_with_tokenizer(enc, standins.ByteTokenizer, "source_text_input_ids", "source_decoded")


def _vocabulary():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return partial(dictionary.FileTokenizer, path), dictionary.special_strings(path)


@query
def vocabulary_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 / U2 / H23 on a real vocabulary: texts encoded by a dictionary of their
    distinct pieces, and decoded to what they were."""
    tokenizer, special = _vocabulary()
    enc = dictionary.encode_by_dictionary(fx.pairs(spark, sf_dir), "source_text", tokenizer, LONGEST, special=special)
    return udf.decode_with_tokenizer(enc, tokenizer, "input_ids", "source_decoded", clean_up_tokenization_spaces=False)


@query
def vocabulary_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 with a real vocabulary on whole texts: how many rows have the ids that
    the dictionary gives, cut and padded alike."""
    tokenizer, special = _vocabulary()
    pairs = fx.pairs(spark, sf_dir)
    whole = udf.encode_with_tokenizer(pairs, tokenizer, {"source_text": PAIR_LENGTH})
    by_piece = dictionary.encode_by_dictionary(pairs, "source_text", tokenizer, PAIR_LENGTH, special=special, pad_id=0)
    same = (F.col("source_text_input_ids") == F.col("input_ids")) & (F.col("source_text_attention_mask") == F.col("attention_mask"))
    return whole.join(by_piece, "row_id").groupBy((F.col("row_id") % 2).alias("grp")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(same, F.lit(1))).alias("n_same"))


GENERATE_OPTIONS = dict(max_length=PAIR_LENGTH, num_beams=2, top_k=10, top_p=0.95,
                        repetition_penalty=2.5, length_penalty=1.0, early_stopping=True)
RETURN_SEQUENCES = 2


@query
def batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return udf.generate(fx.pairs(spark, sf_dir), standins.EchoModel, num_return_sequences=RETURN_SEQUENCES,
                        **GENERATE_OPTIONS)


@query
def metric_callback(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = udf.metric(fx.logits(spark, sf_dir), standins.accuracy_partial, ["n_examples", "n_correct"],
                     lambda c: {"accuracy": c["n_correct"] / c["n_examples"]}, cols=["logits", "label"])
    return out.select(F.col("n_examples").cast("bigint").alias("n_examples"),
                      F.col("n_correct").cast("bigint").alias("n_correct"), "accuracy")


@query
def metric_rank_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U5 with a rank metric: per group of examples, how well the largest logit
    tells right predictions from wrong ones."""
    rows = fx.logits(spark, sf_dir).select(
        (F.col("example_id") % 5).alias("grp"), F.array_max("logits").cast("double").alias("score"),
        (argmax("logits") == F.col("label")).alias("right"))
    return states.metric_by_states(rows, states.Auc("score", "right"), ["auc", "n_positive", "n_negative"], ["score", "right"], ["grp"])


# ---- step 7: staging and the prepared dataset -------------------------------

@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "pairs-csv")
    files.write_pairs_csv(fx.pairs(spark, sf_dir), path)
    return files.read_pairs_csv(spark, path, schema=PAIR_ROW_SCHEMA)


@query
def csv_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 on records that run over many lines: every blank of a text becomes a
    quoted word and a line feed, so blocks of a file start inside quotes."""
    path = staging_path(spark, "lines-csv")
    broken = F.replace("source_text", F.lit(" "), F.lit(BROKEN_BLANK))
    files.write_pairs_csv(fx.pairs(spark, sf_dir).withColumn("source_text", broken), path)
    return files.read_pairs_csv(spark, path, schema=PAIR_ROW_SCHEMA)


ORDER_COLUMNS = ("epoch", "rank", "pos_in_rank", "batch_id", "row_id", "is_padding")
PREPARED_SPLIT, PREPARED_EPOCH, PREPARED_RANK = "train", 1, 3
STORE_GROUP_ROWS = 256
GROWTH = (100, 1000)


def _order(pairs: DataFrame, split_col: str | None = None) -> DataFrame:
    order = assign_batch(assign_rank(shuffle_position(pairs, epochs=EPOCHS, seed=SEED), world_size=WORLD,
                                     devices_per_node=DEVICES_PER_NODE), BATCH).select(*ORDER_COLUMNS)
    if split_col:
        order = order.withColumn(split_col, F.when(F.col("row_id") % 10 == 8, "validation").otherwise("train"))
    return order


def _prepared(spark: SparkSession, sf_dir: str, split_col: str | None = None) -> str:
    pairs = fx.pairs(spark, sf_dir)
    order = _order(pairs, split_col)
    path = staging_path(spark, "prepared")
    files.write_prepared(pairs, order, path, lambda d: encode_pairs(
        d, source_max_length=PAIR_LENGTH, target_max_length=PAIR_LENGTH, keep=order.columns), split_col=split_col)
    return path


@query
def prepared_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prepared dataset, read back with the real source lengths."""
    rows = files.read_prepared(spark, _prepared(spark, sf_dir))
    real = F.size(F.array_remove("source_text_attention_mask", 0))
    return rows.select(*ORDER_COLUMNS, real.alias("source_len"))


@query
def prepared_rank_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token arrays of one split, epoch and rank, from that folder alone."""
    rows = files.read_prepared(spark, _prepared(spark, sf_dir, "split"), PREPARED_EPOCH, PREPARED_RANK, PREPARED_SPLIT)
    return rows.select("pos_in_rank", "batch_id", "row_id", "source_text_input_ids", "source_text_attention_mask",
                       "labels", "labels_attention_mask")


def _store(spark: SparkSession, sf_dir: str, split_col: str | None = None) -> str:
    pairs = fx.pairs(spark, sf_dir)
    path = staging_path(spark, "store")
    prepared.write_store(pairs, _order(pairs, split_col), path, lambda d: encode_pairs(
        d, source_max_length=PAIR_LENGTH, target_max_length=PAIR_LENGTH, keep=("row_id",)), split_col=split_col,
        group_rows=STORE_GROUP_ROWS)
    return path


@query
def prepared_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 with the payload written once: all epochs and ranks by their locators,
    with the real source lengths."""
    rows = prepared.read_store(spark, _store(spark, sf_dir), columns=["source_text_attention_mask"])
    real = F.size(F.array_remove("source_text_attention_mask", 0))
    return rows.select(*ORDER_COLUMNS, real.alias("source_len"))


@query
def prepared_store_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token arrays of one split, epoch and rank, from the row groups
    that its locators name."""
    rows = prepared.read_store(spark, _store(spark, sf_dir, "split"), PREPARED_EPOCH, PREPARED_RANK, PREPARED_SPLIT)
    return rows.select("pos_in_rank", "batch_id", "row_id", "source_text_input_ids", "source_text_attention_mask",
                       "labels", "labels_attention_mask")


@query
def split_corpus_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the corpus staged as Parquet folders per split (``split=<name>``)
    and read back through the named-split source."""
    path = staging_path(spark, "split-corpus")
    fx.corpus(spark, sf_dir).write.partitionBy("split").parquet(path)
    return files.read_split_corpus(spark, path).select("doc_id", "grp", "split", "text")


@query
def monitor_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The F3 log written as text, several files per host, and read
    back with line numbers counted per host across its files."""
    path = staging_path(spark, "monitor-text")
    files.write_text_log(fx.monitor_log(spark, sf_dir), path)
    return files.read_text_lines(spark, path, source="source")


@query
def monitor_growing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 over three runs: the F3 log arrives in three parts per host, each run
    reads the files that are new and goes on counting."""
    path, root = staging_path(spark, "growing-text"), staging_path(spark, "growing-root")
    log = fx.monitor_log(spark, sf_dir)
    for low, high in zip((0, *GROWTH), (*GROWTH, None)):
        part = log.where(F.col("line_no") >= low)
        files.write_text_log(part if high is None else part.where(F.col("line_no") < high), path, mode="append")
        growing.ingest(spark, path, root)
    return growing.read_ingested(spark, root)


@query
def inventory_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + A8 from files: the inventory text of every host captured under
    ``source=<host>/`` and parsed back."""
    path = staging_path(spark, "inventory-text")
    files.write_text_by_source(fx.inventory_lines(spark, sf_dir), path, "line")
    return tm.parse_inventory(files.read_inventory(spark, path, source="source"))


@query
def banner_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + H12 from files: each host's banner captured as one file and
    parsed back."""
    path = staging_path(spark, "banner-text")
    files.write_text_by_source(fx.driver_banners(spark, sf_dir), path, "text")
    return tm.parse_versions(files.read_banners(spark, path, source="source"))


# ---- step 8: streams --------------------------------------------------------

STREAM_WINDOW = "10 minutes"
STEP_WINDOW = "1 hour"
STREAM_DELAY = "1 hour"
SERIES_DELAY = "3650 days"
RANKS = 4


@query
def stream_device_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = staging_path(spark, "monitor-in")
    fx.monitor_log(spark, sf_dir).write.parquet(src)
    out, ck = staging_path(spark, "monitor-out"), staging_path(spark, "monitor-ck")
    lines = spark.readStream.schema(streams.MONITOR_SCHEMA).parquet(src)
    streams.run_to_table(streams.device_max_stream(lines, STREAM_WINDOW, STREAM_DELAY), out, ck)
    return streams.latest(spark, out, ["window_start", "window_end", "source", "device"])


@query
def stream_device_max_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over two runs of one stream: the second brings rows older than the
    watermark (the first lines of each log once more, at full utilisation),
    which change no window."""
    src = staging_path(spark, "monitor-late-in")
    log = fx.monitor_log(spark, sf_dir)
    out, ck = staging_path(spark, "monitor-late-out"), staging_path(spark, "monitor-late-ck")
    late = log.where("line_no < 20").withColumn(
        "line", F.regexp_replace("line", r"^([^,]*, [^,]*), [^,]*,", "$1, 101,"))
    for rows in (log, late):
        rows.write.mode("append").parquet(src)
        lines = spark.readStream.schema(streams.MONITOR_SCHEMA).parquet(src)
        streams.run_to_table(streams.device_max_stream(lines, STREAM_WINDOW, STREAM_DELAY), out, ck)
    return streams.latest(spark, out, ["window_start", "window_end", "source", "device"])


@query
def stream_device_max_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 in append mode: every window is written once, when the watermark has
    closed it, and the table is read as it is.  A second run brings samples of a
    much later day, which close the windows of the first."""
    src = staging_path(spark, "monitor-append-in")
    log = fx.monitor_log(spark, sf_dir)
    out, ck = staging_path(spark, "monitor-append-out"), staging_path(spark, "monitor-append-ck")
    later = log.where("line_no < 20").withColumn(
        "line", F.regexp_replace("line", r"^([^,]*), [^,]*,", "$1, 2099/01/01 00:00:00.0,"))
    for rows in (log, later):
        rows.write.mode("append").parquet(src)
        lines = spark.readStream.schema(streams.MONITOR_SCHEMA).parquet(src)
        streams.run_to_table(streams.device_max_stream(lines, STREAM_WINDOW, STREAM_DELAY), out, ck, output_mode="append")
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_text_device_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 stream form + T1: the F3 log arriving as text files per host
    (``source=<host>/``), parsed and maximised per tumbling window."""
    src = staging_path(spark, "monitor-text-in")
    files.write_text_log(fx.monitor_log(spark, sf_dir), src)
    out, ck = staging_path(spark, "monitor-text-out"), staging_path(spark, "monitor-text-ck")
    lines = streams.read_text_stream(spark, src, source_key="source")
    streams.run_to_table(streams.device_max_stream(lines, STREAM_WINDOW, STREAM_DELAY), out, ck)
    return streams.latest(spark, out, ["window_start", "window_end", "source", "device"])


@query
def stream_step_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = staging_path(spark, "steps-in")
    fx.step_metrics(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    out, ck = staging_path(spark, "steps-out"), staging_path(spark, "steps-ck")
    steps = spark.readStream.schema(streams.STEP_SCHEMA).parquet(src)
    streams.run_to_table(streams.step_loss_stream(steps, STEP_WINDOW, STREAM_DELAY), out, ck)
    return streams.latest(spark, out, ["window_start", "window_end", "run_id", "phase", "epoch"])


@query
def stream_step_loss_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on a feed that repeats rows: a restarted query gets a part of the
    steps once more, with other losses, and no mean changes."""
    src = staging_path(spark, "replayed-in")
    out, ck = staging_path(spark, "replayed-out"), staging_path(spark, "replayed-ck")
    first = fx.step_metrics(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    again = first.where("step % 3 = 1").withColumn("loss", F.col("loss") + 1000.0)
    for rows in (first, again):
        rows.write.mode("append").parquet(src)
        steps = spark.readStream.schema(streams.STEP_SCHEMA).parquet(src)
        streams.run_to_table(streams.step_loss_stream(steps, STEP_WINDOW, STREAM_DELAY, distinct=True), out, ck)
    return streams.latest(spark, out, ["window_start", "window_end", "run_id", "phase", "epoch"])


@query
def stream_percent_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 on a stream in two runs: the second one, after a restart, goes on
    from the first samples that the first one has kept."""
    src = staging_path(spark, "series-in")
    log = fx.monitor_log(spark, sf_dir)
    out, ck = staging_path(spark, "series-out"), staging_path(spark, "series-ck")
    for part in (log.where(F.col("line_no") < GROWTH[1]), log.where(F.col("line_no") >= GROWTH[1])):
        part.write.mode("append").parquet(src)
        lines = spark.readStream.schema(streams.MONITOR_SCHEMA).parquet(src)
        streams.run_to_table(stateful.percent_series_stream(lines, SERIES_DELAY), out, ck, output_mode="append")
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on the live feed: ranks report out of order over three batches, each
    of a query of its own; an epoch counts when all ranks have reported it."""
    src = staging_path(spark, "reports-in")
    out, ck = staging_path(spark, "reports-out"), staging_path(spark, "reports-ck")
    reports = fx.rank_reports(spark, sf_dir, RANKS, MAX_EPOCHS)
    for batch in range(3):
        reports.where((F.col("epoch") * 2 + F.col("rank") * 5) % 3 == batch).write.mode("append").parquet(src)
        feed = spark.readStream.schema(fx.REPORT_SCHEMA).parquet(src)
        streams.run_to_table(stateful.early_stop_stream(feed, PATIENCE, RANKS), out, ck, output_mode="append")
    seen = spark.read.parquet(out)
    return seen.groupBy("run_id").agg(
        F.max(F.when(F.col("stops"), F.col("epoch"))).alias("stop_epoch"),
        F.max_by("best_epoch", "epoch").alias("best_epoch"),
        round_half_even(F.max_by("best_value", "epoch"), 12).alias("best_value"),
        F.count(F.lit(1)).alias("n_epochs"))
