"""User-function surfaces.

These are the only places where rows go through Python.  They all run on
Arrow batches (``mapInPandas``), and every factory (tokenizer, model) is
built once per task, not once per batch or per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.functions.tokens import preset as get_preset


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema: T.StructType | str) -> DataFrame:
    """Apply ``fn`` to every pandas batch; it may change the row count.
    ``schema`` is the output schema (mandatory: Spark plans before it runs)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply preprocessors in order (Catalyst fuses the native ones)."""
    for step in steps:
        df = df.transform(step)
    return df


def _labels(ids: np.ndarray, mask: np.ndarray, mode: str, pad: int) -> np.ndarray:
    if mode == "copy":
        return ids.copy()
    if mode == "mask_zero":
        return np.where(ids == 0, -100, ids)
    if mode == "mask_pad":
        return np.where(mask == 0, -100, ids)
    raise ValueError(f"unknown labels mode {mode!r}")


def encode_with_tokenizer(df: DataFrame, tokenizer_factory: Callable[[], Callable],
                          text_cols: dict[str, int], keep: Sequence[str] = ("row_id",),
                          labels: dict[str, str] | None = None) -> DataFrame:
    """Encode text columns with a user tokenizer.

    ``text_cols`` maps each text column to its fixed length.  The tokenizer
    is called like the common tokenizer interface, ``tok(texts,
    max_length=n, padding="max_length", truncation=True,
    add_special_tokens=True)`` and must return ``input_ids`` and
    ``attention_mask`` (2-D, one row per text).  For each column ``c`` the
    output has ``c_input_ids`` and ``c_attention_mask``; ``labels`` maps a
    column to a label rule (``copy``, ``mask_zero``, ``mask_pad``) whose
    result is written to ``labels`` (one such column at most).
    """
    labels = labels or {}
    fields = [df.schema[k] for k in keep]
    for c in text_cols:
        fields += [T.StructField(f"{c}_input_ids", T.ArrayType(T.IntegerType())),
                   T.StructField(f"{c}_attention_mask", T.ArrayType(T.IntegerType()))]
    if labels:
        fields.append(T.StructField("labels", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    keep = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer_factory()          # once per task
        for b in batches:
            out = {k: b[k] for k in keep}
            for c, n in text_cols.items():
                texts = b[c].tolist()
                if any(t is None for t in texts):
                    raise ValueError(f"null value in column {c}")
                enc = tok(texts, max_length=n, padding="max_length", truncation=True,
                          add_special_tokens=True)
                ids = np.asarray(enc["input_ids"], dtype=np.int32).reshape(len(texts), n)
                mask = np.asarray(enc["attention_mask"], dtype=np.int32).reshape(len(texts), n)
                out[f"{c}_input_ids"] = list(ids)
                out[f"{c}_attention_mask"] = list(mask)
                if c in labels:
                    out["labels"] = list(_labels(ids, mask, labels[c], 0))
            yield pd.DataFrame(out)
    return df.mapInPandas(run, schema)


def decode_with_tokenizer(df: DataFrame, tokenizer_factory: Callable[[], object], ids_col: str, out_col: str = "text",
                          keep: Sequence[str] = ("row_id",), skip_special_tokens: bool = True,
                          clean_up_tokenization_spaces: bool = True) -> DataFrame:
    """H23 through U2: ids back to text with a user tokenizer, whose
    ``decode(ids, skip_special_tokens=..., clean_up_tokenization_spaces=...)``
    is called per row; null ids give a null text."""
    keep = list(keep)
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer_factory()          # once per task
        for b in batches:
            text = [None if ids is None else tok.decode(ids, skip_special_tokens=skip_special_tokens,
                                                        clean_up_tokenization_spaces=clean_up_tokenization_spaces)
                    for ids in b[ids_col]]
            yield b[keep].assign(**{out_col: pd.Series(text, index=b.index, dtype="object")})
    return df.select(*keep, ids_col).mapInPandas(run, schema)


def generate(df: DataFrame, model_factory: Callable[[], object], text_col: str = "source_text",
             id_col: str = "row_id", num_return_sequences: int = 1, **options) -> DataFrame:
    """U4: batch generation with a user model; one output row per returned
    sequence, ``(row_id, seq_no, text)``.

    ``model_factory()`` is called once per task and must return an object
    with ``generate(texts, num_return_sequences=..., **options)`` giving, per
    text, a list of ``num_return_sequences`` strings.  The options of the
    original predictor (``max_length``, ``num_beams``, ``top_k``, ``top_p``,
    ``repetition_penalty``, ``length_penalty``, ``early_stopping``) pass
    through unchanged.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("seq_no", T.IntegerType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()           # once per task
        for b in batches:
            outs = list(model.generate(b[text_col].tolist(), num_return_sequences=num_return_sequences, **options))
            if len(outs) != len(b):
                raise ValueError(f"the model returned outputs for {len(outs)} of {len(b)} texts")
            at, seq, text = [], [], []
            for i, seqs in enumerate(outs):
                if len(seqs) != num_return_sequences:
                    raise ValueError("the model returned a different number of sequences")
                for k, s in enumerate(seqs):
                    at.append(i)
                    seq.append(k)
                    text.append(s)
            ids = b[id_col].iloc[at].reset_index(drop=True)  # of whatever type the column has
            yield pd.DataFrame({id_col: ids, "seq_no": pd.Series(seq, dtype="int32"),
                                "text": pd.Series(text, dtype="object")})
    return df.select(id_col, text_col).mapInPandas(run, schema)


def metric(df: DataFrame, partial: Callable[[pd.DataFrame], dict[str, float]],
           partial_names: Sequence[str], final: Callable[[dict[str, Column]], dict[str, Column]],
           cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A metric callback over predictions and labels, split into an
    additive part and a final formula.

    ``partial(batch)`` returns sums (counts, totals) for one Arrow batch;
    Spark adds them up per key (partial/final aggregation, nothing is
    collected in one place) and ``final`` turns the sums into the metric
    with column expressions.  Accuracy, for example, is ``correct`` and
    ``n`` as partials and ``correct / n`` as the final formula.
    """
    keys = list(keys)
    schema = T.StructType([df.schema[k] for k in keys]
                          + [T.StructField(n, T.DoubleType()) for n in partial_names])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            groups = b.groupby(keys, sort=False, dropna=False) if keys else [((), b)]
            rows = []
            for key, g in groups:
                vals = partial(g)
                key = key if isinstance(key, tuple) else (key,)
                key = [None if pd.isna(k) else k for k in key]
                rows.append(key + [float(vals[n]) for n in partial_names])
            yield pd.DataFrame(rows, columns=keys + list(partial_names))
    parts = df.select(*keys, *cols).mapInPandas(run, schema)
    sums = parts.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in partial_names])
    extra = final({n: F.col(n) for n in partial_names})
    return sums.select(*keys, *partial_names, *[c.alias(n) for n, c in extra.items()])
