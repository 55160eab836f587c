"""Corpus operators: split text into clean lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera.functions.text import is_heading, py_strip, split_lines_col
from tessera.operators.ordered import carry


def _clean(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Strip once, then drop blank lines and heading lines."""
    df = df.withColumn(out, py_strip(raw)).drop(raw) if raw != out else df.withColumn(out, py_strip(raw))
    return df.where((F.col(out) != F.lit("")) & ~is_heading(out))


def split_lines(df: DataFrame, text_col: str = "text", scope: str = "document",
                key_col: str = "doc_id", group_col: str | Sequence[str] | None = None,
                order_col: str | None = None, keep: Sequence[str] = (),
                chunk: int = 1 << 16, dense_order: bool = False, on_null: str = "error") -> DataFrame:
    """Split texts into stripped, non-blank, non-heading lines.

    ``scope='document'``: every row is split on its own; output
    ``(*keep, key_col, line_no, text)`` where ``line_no`` is the index of the
    piece in the row's text.  No shuffle.

    ``scope='group'``: the texts of a group are joined in ``order_col``
    order with no separator, so a line may run across rows.  ``group_col`` is a
    column or a list (such as split and source: texts of different splits must
    not run into each other).  Output ``(*group_col, key_col, line_no, text)``
    where ``(key_col, line_no)`` is the row and piece in which the line starts;
    ``keep`` is refused here, since a line may belong to several rows.  Lines inside one row are
    never shuffled; only the first and last piece of each row take part in
    the joining step, and the "previous row with a line feed" lookup is done
    in bounded chunks, so a hot group does not end up in one task.  (A
    single line spanning a whole group is, by definition, one output value.)
    Chunks are runs of ``chunk`` rows by position; pass ``dense_order=True``
    when the order values are dense integers, to take ranges of values instead
    and save the numbering.

    A null text fails the job by default; ``on_null='drop'`` leaves it out.
    """
    if on_null not in ("error", "drop"):
        raise ValueError("on_null must be 'error' or 'drop'")
    if on_null == "error":
        t = F.col(text_col)
        df = df.withColumn(text_col, F.when(t.isNull(), F.raise_error(F.lit(f"null value in column {text_col}"))
                                            .cast("string")).otherwise(t))
    if scope == "document":
        out = df.select(*keep, key_col, *_explode(split_lines_col(text_col), "line_no", "_raw"))
        out = out.where(F.col("line_no").isNotNull()).withColumn("line_no", F.col("line_no").cast("bigint"))
        return _clean(out, "_raw", text_col)
    if scope != "group":
        raise ValueError(f"unknown scope {scope!r}; use 'document' or 'group'")
    if group_col is None:
        raise ValueError("scope='group' needs group_col")
    if keep:
        raise ValueError("scope='group' takes no keep columns: add them to group_col")
    order_col = order_col or key_col
    names = [group_col] if isinstance(group_col, str) else list(group_col)
    g, o = "_g", order_col  # one struct of all group columns: nulls in it are equal
    df = df.withColumn(g, F.struct(*names))
    base = df.select(F.col(g).alias(g), F.col(o).alias(o), split_lines_col(text_col).alias("_parts"))
    base = base.withColumn("_nl", F.size("_parts") - 1)
    ex = base.select(g, o, "_nl", *_explode(F.col("_parts"), "_pos", "_frag")).where(F.col("_pos").isNotNull())

    # lines inside one row: complete, never shuffled
    interior = ex.where((F.col("_pos") > 0) & (F.col("_pos") < F.col("_nl"))).select(
        g, F.col(o).alias(key_col), F.col("_pos").cast("bigint").alias("line_no"), F.col("_frag").alias("_raw"))

    # first and last piece of every row: the last piece of a row with a line
    # feed opens a line; the first piece of a row continues the line opened
    # by the nearest earlier opening piece (none: the group's first line)
    boundary = ex.where((F.col("_pos") == 0) | (F.col("_pos") == F.col("_nl")))
    opens = (F.col("_pos") == F.col("_nl")) & (F.col("_nl") > 0)
    brk = F.when(opens, F.struct(F.col(o).alias("d"), F.col("_nl").cast("bigint").alias("p")))
    boundary = carry(boundary, brk, "_start", [g], [o, "_pos"], direction="forward", inclusive=False,
                     chunk=chunk, chunk_by="value" if dense_order else "position")
    keyed = boundary.select(
        g,
        F.when(opens, F.col(o)).otherwise(F.col("_start.d")).alias("_sd"),
        F.when(opens, F.col("_nl").cast("bigint")).otherwise(F.col("_start.p")).alias("_sp"),
        F.col(o).alias("_o"), F.col("_pos").alias("_p"), "_frag")
    joined = (
        keyed.groupBy(g, "_sd", "_sp")
        .agg(F.min("_o").alias("_o0"),
             F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_p", "_frag"))),
                                      lambda x: x["_frag"]), "").alias("_raw"))
        .select(g, F.coalesce("_sd", "_o0").alias(key_col),
                F.coalesce("_sp", F.lit(0).cast("bigint")).alias("line_no"), "_raw")
    )
    out = interior.unionByName(joined).select(*[F.col(g)[n].alias(n) for n in names], key_col, "line_no", "_raw")
    return _clean(out, "_raw", text_col)


def _explode(arr, pos: str, val: str):
    """``posexplode_outer``: the inner form makes the optimizer add a
    ``size(array) > 0`` filter below the projection, which splits every text
    a second time; null rows (null text) are filtered by the caller."""
    return [F.posexplode_outer(arr).alias(pos, val)]


def select_splits(df: DataFrame, split_col: str = "split",
                  mapping: dict[str, str] | None = None) -> DataFrame:
    """Keep the named splits and rename them; others are dropped.
    Default: ``train`` stays ``train``, ``validation`` becomes ``evaluation``."""
    mapping = mapping or {"train": "train", "validation": "evaluation"}
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.where(F.col(split_col).isin(list(mapping))).withColumn(split_col, m[F.col(split_col)])
