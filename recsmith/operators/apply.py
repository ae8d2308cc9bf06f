"""Pandas function surface (D1, D2): the places where per-group or
per-partition imperative code is genuinely wanted. Arrow-batched; the
grouping or partitioning is Spark's."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.operators.encode import range_numbered


def group_apply(df: DataFrame, keys: list[str], func: Callable[[pd.DataFrame], pd.DataFrame],
                schema: str) -> DataFrame:
    """Run a pandas function on each group and concatenate the results
    (``groupBy(keys).applyInPandas``). Each group is one task's input, so
    use it for groups of bounded size (e.g. per user with a length cap
    enforced upstream) or functions that stream."""
    return df.groupBy(*keys).applyInPandas(func, schema)


def partition_apply(df: DataFrame, func: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                    schema: str) -> DataFrame:
    """A row generator over each partition's Arrow batches
    (``mapInPandas``); small shared values are captured in the closure."""
    return df.mapInPandas(func, schema)


def next_gap_pandas(time_col: str = "time", item_col: str = "item_id", scale: float = 3600.0):
    """Pandas body of W6 for D1: next-event gap within one user's rows."""
    def fn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([time_col, item_col], kind="mergesort")
        gap = (g[time_col].shift(-1) - g[time_col]) / scale
        out = g.assign(gap=gap)
        return out[out["gap"].notna()]
    return fn


# ------------------------------------------------- groups that do not fit a task

def _key_starts(keys: pd.Series) -> np.ndarray:
    """Places at which a key begins (null is a key like any other)."""
    if len(keys) == 0:
        return np.zeros(0, dtype=np.int64)
    same = ((keys == keys.shift()) | (keys.isna() & keys.shift().isna())).to_numpy(dtype=bool, na_value=False)
    same[0] = False
    return np.flatnonzero(~same)


def _equal(a: Any, b: Any) -> bool:
    return (pd.isna(a) and pd.isna(b)) or (not pd.isna(a) and not pd.isna(b) and a == b)


def run_apply(df: DataFrame, key: str, order: list[str], func: Callable[..., pd.DataFrame], schema: str, before: int = 0, after: int = 0,
              fold: tuple[Any, Callable[[Any, pd.DataFrame], Any], Callable[[Any, Any], Any]] | None = None) -> DataFrame:
    """D1 for groups of any size: rows are range partitioned and sorted on (key,
    order), and a group streams through ``func`` in runs of bounded size, a large
    group over many tasks.

    ``func(frame, start, stop)`` gets a run as rows [start, stop) of a frame that
    also has the last ``before`` rows of the group ahead of it and the first
    ``after`` rows behind it, and returns the output for the run. With ``fold`` =
    (zero, step, merge) it gets as fourth argument the state of the group ahead
    of the run: ``step(state, rows)`` of all rows before, where ``merge`` joins
    the states of two stretches of a group.

    What crosses the border of two partitions comes from a boundary table: the
    first ``after`` and last ``before`` rows of each partition and, for a fold,
    the state of its last group, found by one more pass over the sorted rows.
    It has a row for each of these and partition, so its size does not depend on
    the groups. The sorted rows are written once and read in their partitions."""
    names = df.columns
    ranged = range_numbered(df, [F.col(key).asc(), *[F.col(c).asc() for c in order]])
    spark = df.sparkSession
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_rows"))
    edges = (ranged.join(F.broadcast(counts), "_pid")  # one row a partition
             .where((F.col("_idx") < after) | (F.col("_idx") >= F.col("_rows") - before)) if before or after else None)
    heads: dict[int, pd.DataFrame] = {}
    tails: dict[int, pd.DataFrame] = {}
    if edges is not None:
        frame = edges.orderBy("_pid", "_idx").toPandas()
        for pid, part in frame.groupby("_pid"):
            heads[pid] = part[part["_idx"] < after][names].reset_index(drop=True)
            tails[pid] = part[part["_idx"] >= part["_rows"] - before][names].reset_index(drop=True)
    states: dict[int, Any] = {}
    if fold is not None:
        zero, step, merge = fold

        def last_group(batches):
            pid, first, last, state, single = None, None, None, zero, True
            for batch in batches:
                rows = batch.to_pandas()
                if len(rows) == 0:
                    continue
                at = _key_starts(rows[key])
                if pid is None:
                    pid, first, last = int(rows["_pid"].iloc[0]), rows[key].iloc[0], rows[key].iloc[0]
                for k, lo in enumerate(at):
                    hi = at[k + 1] if k + 1 < len(at) else len(rows)
                    own = rows[key].iloc[lo]
                    if not _equal(own, last):
                        state, single, last = zero, False, own
                    if k == len(at) - 1:
                        state = step(state, rows.iloc[lo:hi][names])
            if pid is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int64()), pa.array([pickle.dumps((first, last, single, state))], pa.binary())],
                                                 names=["pid", "edge"])

        known, held, owner = [(r.pid, *pickle.loads(r.edge)) for r in ranged.mapInArrow(last_group, "pid long, edge binary").collect()], zero, None
        for pid, first, last, single, state in sorted(known, key=lambda r: r[0]):
            # what the partitions before hold of this partition's first group
            states[pid] = held if owner is not None and _equal(owner[0], first) else zero
            held = merge(states[pid], state) if single else state
            owner = (last,)
    shared = spark.sparkContext.broadcast((heads, tails, states))

    def scan(frames):
        heads, tails, states = shared.value
        ahead = state = None  # rows of the current group that went before
        rows = None
        pid = None

        def neighbours(side: dict[int, pd.DataFrame], own: Any, want: int, down: bool) -> pd.DataFrame | None:
            """Rows of the group `own` in the partitions on one side."""
            found, have = [], 0
            for p in sorted((p for p in side if (p < pid if down else p > pid)), reverse=down):
                part = side[p]
                if len(part) == 0 or have >= want:
                    break
                mine = part[[_equal(v, own) for v in part[key]]]
                found.append(mine)
                have += len(mine)
                if len(mine) < len(part):
                    break
            if not found:
                return None
            both = pd.concat(found[::-1] if down else found, ignore_index=True)
            return both.tail(want) if down else both.head(want)

        def emit(run: pd.DataFrame, behind: pd.DataFrame | None):
            nonlocal ahead, state
            parts = [x for x in (ahead, run, behind) if x is not None and len(x)]
            start = 0 if ahead is None else len(ahead)
            frame = pd.concat(parts, ignore_index=True) if len(parts) > 1 else run.reset_index(drop=True)
            args = (frame, start, start + len(run)) + ((state,) if fold is not None else ())
            out = func(*args)
            if fold is not None:
                state = fold[1](state, run)
            if before:
                ahead = pd.concat([x for x in (ahead, run) if x is not None], ignore_index=True).tail(before)
            return out

        def begin(own: Any, first: bool):
            nonlocal ahead, state
            ahead = neighbours(tails, own, before, True) if first and before else None
            state = states.get(pid, fold[0]) if first and fold is not None else (fold[0] if fold is not None else None)

        current = None  # (key,) of the group that `rows` belong to
        for more in frames:
            if len(more) == 0:
                continue
            if pid is None:
                pid = int(more["_pid"].iloc[0])
            more = more[names]
            at = _key_starts(more[key])
            for k, lo in enumerate(at):
                part = more.iloc[lo:at[k + 1] if k + 1 < len(at) else len(more)]
                own = part[key].iloc[0]
                if current is None or not _equal(current[0], own):
                    if rows is not None:
                        yield emit(rows, None)
                    begin(own, current is None)
                    current, rows = (own,), None
                rows = part if rows is None else pd.concat([rows, part], ignore_index=True)
                if after and len(rows) > after:
                    yield emit(rows.iloc[:-after], rows.iloc[-after:])
                    rows = rows.iloc[-after:]
                elif not after:
                    yield emit(rows, None)
                    rows = None
        if rows is not None and len(rows):
            yield emit(rows, neighbours(heads, current[0], after, False))

    return ranged.mapInPandas(scan, schema)


def next_gap_run(time_col: str = "time", scale: float = 3600.0):
    """Body of W6 for :func:`run_apply` with ``after=1``."""
    def fn(frame: pd.DataFrame, start: int, stop: int) -> pd.DataFrame:
        gap = (frame[time_col].shift(-1) - frame[time_col]) / scale
        out = frame.assign(gap=gap).iloc[start:stop]
        return out[out["gap"].notna()]
    return fn


def count_fold():
    """Fold that counts the rows of a group."""
    return 0, lambda state, rows: state + len(rows), lambda a, b: a + b


def position_run(name: str = "loc"):
    """Body of W8 for :func:`run_apply` with :func:`count_fold`."""
    def fn(frame: pd.DataFrame, start: int, stop: int, state: int) -> pd.DataFrame:
        return frame.iloc[start:stop].assign(**{name: np.arange(state, state + stop - start)})
    return fn
