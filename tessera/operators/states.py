"""U5 for metrics that are no sums: mergeable states, merged as a tree.

A metric is four functions, as an aggregate function of a database has them::

    init() -> state            update(state, frame) -> state
    merge(state, state) -> state      finish(state) -> dict of numbers

Rows never travel: every task folds its rows into one state per key and hands
the pickled states on; states of a key are merged in groups and the results once
more, so no task merges more than a share of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


class Metric(Protocol):
    """What :func:`metric_by_states` needs; instances are sent to the tasks."""

    def init(self) -> Any: ...
    def update(self, state: Any, rows: pd.DataFrame) -> Any: ...
    def merge(self, a: Any, b: Any) -> Any: ...
    def finish(self, state: Any) -> dict[str, float | None]: ...


#: Keys whose states a task holds before it hands all of them on.
HELD = 10_000
#: Groups of tasks that a key's states are merged in first.
FANS = 32


def metric_by_states(df: DataFrame, metric: Metric, names: Sequence[str], cols: Sequence[str],
                     keys: Sequence[str] = (), fans: int = FANS) -> DataFrame:
    """One row per key with the metric's ``names`` as doubles.

    Null keys are keys like any other.  Without ``keys`` there is one row, also
    for an empty table (the finished initial state).  Results depend on the order
    of rows and merges only as far as ``update`` and ``merge`` do.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    states = T.StructType([*key_fields, T.StructField("_fan", T.IntegerType()), T.StructField("_state", T.BinaryType())])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Any] = {}

        def handed_on() -> pd.DataFrame:
            rows = [(*k, i % fans, pickle.dumps(s)) for i, (k, s) in enumerate(held.items(), start)]
            held.clear()
            return pd.DataFrame(rows, columns=[*keys, "_fan", "_state"]).astype(object)

        start = 0
        for b in batches:
            if not start and len(b):
                start = int(b["_task"].iloc[0])
            for key, rows in b.groupby(keys, sort=False, dropna=False) if keys else [((), b)]:
                key = tuple(None if pd.isna(k) else k for k in key)
                held[key] = metric.update(held[key] if key in held else metric.init(), rows)
            if len(held) >= HELD:
                yield handed_on()
        yield handed_on()

    def merged(group: pd.DataFrame) -> Any:
        return reduce(metric.merge, map(pickle.loads, group["_state"]), metric.init())

    def branch(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*group[keys].iloc[0], 0, pickle.dumps(merged(group)))], columns=[*keys, "_fan", "_state"]).astype(object)

    def root(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        done = metric.finish(merged(group))
        return pd.DataFrame([(*group[keys].iloc[0], *(done[n] for n in names))], columns=[*keys, *names]).astype(object)

    parts = df.select(*keys, *cols, F.spark_partition_id().alias("_task")).mapInPandas(fold, states)
    if not keys:  # a row even where there is none
        none = df.sparkSession.createDataFrame([(0, pickle.dumps(metric.init()))], states)
        parts = parts.unionByName(none)
    some = parts.groupBy(*keys, "_fan").applyInPandas(branch, states)
    out = T.StructType([*key_fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    # a group's key columns are read from its rows: applyInPandas groups nulls together
    return (some.groupBy(*keys) if keys else some.groupBy("_fan")).applyInPandas(root, out)


class Auc:
    """Area under the ROC curve: the chance that a positive example scores above
    a negative one, ties half.  Scores are taken in steps of ``1 / grid``, so a
    state is two counts per step that occurs and merging is exact."""

    def __init__(self, score: str, positive: str, grid: int = 1024):
        self.score, self.positive, self.grid = score, positive, grid

    def init(self) -> dict[int, tuple[int, int]]:
        return {}

    def update(self, state: dict, rows: pd.DataFrame) -> dict:
        rows = rows[rows[self.score].notna() & rows[self.positive].notna()]
        step = np.floor(rows[self.score].to_numpy(dtype=np.float64) * self.grid).astype(np.int64)
        good = rows[self.positive].to_numpy(dtype=bool)
        for at, own in ((0, step[~good]), (1, step[good])):
            for s, n in zip(*np.unique(own, return_counts=True)):
                x = list(state.get(int(s), (0, 0)))
                x[at] += int(n)
                state[int(s)] = (x[0], x[1])
        return state

    def merge(self, a: dict, b: dict) -> dict:
        for s, (n, p) in b.items():
            x = a.get(s, (0, 0))
            a[s] = (x[0] + n, x[1] + p)
        return a

    def finish(self, state: dict) -> dict[str, float | None]:
        below = wins = 0  # wins counts in halves
        for s in sorted(state):
            n, p = state[s]
            wins += p * (2 * below + n)
            below += n
        total = sum(p for _, p in state.values())
        return {"auc": wins / (2 * below * total) if below and total else None, "n_positive": float(total), "n_negative": float(below)}
