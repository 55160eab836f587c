"""Token encoding operators over tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.tokens import decode_ids, encode_text, preset as get_preset


def _checked(df: DataFrame, cols: Sequence[str], on_null: str) -> tuple[DataFrame, dict[str, Column]]:
    """``on_null='error'`` fails the job on a null text, ``'drop'`` drops
    the row."""
    if on_null == "drop":
        cond = None
        for c in cols:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        return df.where(cond), {c: F.col(c) for c in cols}
    if on_null != "error":
        raise ValueError("on_null must be 'error' or 'drop'")
    return df, {c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null value in column {c}")))
                .otherwise(F.col(c)) for c in cols}


def encode_causal(df: DataFrame, text_col: str = "text", max_length: int = 512,
                  preset: str = "causal_copy", keep: Sequence[str] = (),
                  on_null: str = "error") -> DataFrame:
    """Corpus lines to ``(*keep, input_ids, attention_mask, labels)``."""
    df, c = _checked(df, [text_col], on_null)
    enc = encode_text(c[text_col], max_length, preset)
    return df.select(*keep, enc["input_ids"].alias("input_ids"),
                     enc["attention_mask"].alias("attention_mask"), enc["labels"].alias("labels"))


def encode_pairs(df: DataFrame, source_col: str = "source_text", target_col: str = "target_text",
                 source_max_length: int = 256, target_max_length: int = 256,
                 preset: str = "seq2seq", keep: Sequence[str] = ("row_id",),
                 on_null: str = "error") -> DataFrame:
    """Pairs to ``source_text_input_ids, source_text_attention_mask, labels,
    labels_attention_mask`` (all ``ARRAY<INT>``)."""
    p = get_preset(preset)
    if p.name.startswith("causal") and source_max_length != target_max_length:
        raise ValueError("a causal preset feeds ids and labels to one model: lengths must be equal")
    df, c = _checked(df, [source_col, target_col], on_null)
    s = encode_text(c[source_col], source_max_length, p)
    t = encode_text(c[target_col], target_max_length, p)
    return df.select(
        *keep,
        s["input_ids"].alias("source_text_input_ids"),
        s["attention_mask"].alias("source_text_attention_mask"),
        t["labels"].alias("labels"),
        t["attention_mask"].alias("labels_attention_mask"),
    )


def decode(df: DataFrame, ids_col: str, out_col: str = "text", skip_special: bool = True,
           clean_spaces: bool = True) -> DataFrame:
    """Ids to text."""
    return df.withColumn(out_col, decode_ids(ids_col, skip_special, clean_spaces))
