"""Mergeable weighted quantile summaries, for all columns in one pass.

A summary is a sorted array of values, each with bounds on its rank by weight: ``below`` (at least so
much weight lies under the value), ``own`` (at least so much weight has it) and ``upto`` (at most so much
weight lies at or under it). Summaries of exact rows have no slack; merging adds bounds; pruning keeps
about ``size`` of the values, evenly by rank. Each task keeps a ladder of summaries, as many rows in
each step as in all below, so a value is pruned once per step; partial summaries meet by column.
``slack`` tells how far the rank of any quantile may be off, from the bounds themselves.

Missing values (null or NaN) and rows without weight are left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Values kept in a summary, unless asked otherwise.
SIZE = 2048

Summary = np.ndarray  # columns: value, below, own, upto


def exact(values: np.ndarray, weights: np.ndarray) -> Summary:
    """Summary of rows, without slack."""
    kept = ~np.isnan(values) & (weights > 0)
    value, at = np.unique(values[kept], return_inverse=True)
    own = np.bincount(at.ravel(), weights[kept], len(value))
    upto = np.cumsum(own)
    return np.stack([value, upto - own, own, upto], axis=1)


def merge(a: Summary, b: Summary) -> Summary:
    """Summary of the rows of both."""
    if not len(a) or not len(b):
        return a if len(a) else b
    value = np.union1d(a[:, 0], b[:, 0])
    out = np.zeros((len(value), 4))
    out[:, 0] = value
    for s in (a, b):
        at = np.searchsorted(s[:, 0], value)
        same = (at < len(s)) & (s[np.minimum(at, len(s) - 1), 0] == value)
        before = at - 1
        # a value the summary does not have lies between two that it has
        under = np.where(before >= 0, s[before, 1] + s[before, 2], 0.0)
        over = np.where(at < len(s), s[np.minimum(at, len(s) - 1), 3] - s[np.minimum(at, len(s) - 1), 2], s[-1, 3])
        here = np.minimum(at, len(s) - 1)
        out[:, 1] += np.where(same, s[here, 1], under)
        out[:, 2] += np.where(same, s[here, 2], 0.0)
        out[:, 3] += np.where(same, s[here, 3], over)
    return out


def prune(s: Summary, size: int = SIZE) -> Summary:
    """The first, the last, and about ``size`` values between, evenly by rank."""
    if len(s) <= size:
        return s
    wanted = s[-1, 3] * np.arange(1, size - 1) / (size - 1)
    return s[np.unique(np.concatenate([[0], nearest(s, wanted), [len(s) - 1]]))]


def nearest(s: Summary, ranks: np.ndarray) -> np.ndarray:
    """Places of the values whose ranks are nearest to ``ranks``."""
    after = np.minimum(np.searchsorted(s[:, 1] + s[:, 3], 2 * ranks, side="right"), len(s) - 1)
    before = np.maximum(after - 1, 0)
    # halfway between what lies surely up to one value and at most under the next
    middle = s[before, 1] + s[before, 2] + s[after, 3] - s[after, 2]
    return np.where(2 * ranks < middle, before, after)


def slack(s: Summary) -> float:
    """How much weight a rank may be off."""
    if not len(s):
        return 0.0
    gaps = s[1:, 3] - s[1:, 2] - s[:-1, 1] - s[:-1, 2]
    return float(max((s[:, 3] - s[:, 1] - s[:, 2]).max(), gaps.max(initial=0.0)))


def add(ladder: list[Summary | None], s: Summary, size: int = SIZE) -> None:
    """Put a summary on the lowest step; a full step goes up, merged with what comes."""
    for k in range(len(ladder)):
        if ladder[k] is None:
            ladder[k] = s
            return
        s, ladder[k] = prune(merge(ladder[k], s), size), None
    ladder.append(s)


def total(ladder: Sequence[Summary | None], size: int = SIZE) -> Summary:
    out = np.zeros((0, 4))
    for s in ladder:
        if s is not None:
            out = prune(merge(out, s), size)
    return out


def summarise(df: DataFrame, columns: Sequence[str], weight: str | None = None, size: int = SIZE) -> list[Summary]:
    """Summaries of ``columns``, in one job: tasks shuffle one row per column, a task per column adds them up."""
    n = len(columns)
    given = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]
    rows = df.select(*given, (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ladders: list[list[Summary | None]] = [[] for _ in range(n)]
        for b in batches:
            w = b.column(n).to_numpy(zero_copy_only=False)
            w = np.where(np.isnan(w), 0.0, w)
            for k in range(n):
                x = b.column(k).to_numpy(zero_copy_only=False).astype(float)
                add(ladders[k], prune(exact(x, w), size), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()), pa.array([total(x, size).tobytes() for x in ladders], pa.binary())],
            names=["place", "summary"],
        )

    def join(table: pa.Table) -> pa.Table:
        ladder: list[Summary | None] = []
        for blob in sorted(table.column("summary").to_pylist()):  # whatever order the parts come in
            add(ladder, np.frombuffer(blob).reshape(-1, 4), size)
        return pa.table({"place": table.column("place")[:1], "summary": pa.array([total(ladder, size).tobytes()], pa.binary())})

    schema = "place int, summary binary"
    found = rows.mapInArrow(run, schema).groupBy("place").applyInArrow(join, schema).collect()  # one per column
    out = [np.zeros((0, 4))] * n
    for r in found:
        out[r["place"]] = np.frombuffer(r["summary"]).reshape(-1, 4)
    return out


def cuts(s: Summary, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cut points: between neighbouring values where there are few, else quantiles."""
    if len(s) <= bins:
        return (s[1:, 0] + s[:-1, 0]) / 2
    return np.unique(s[nearest(s, s[-1, 3] * np.arange(1, bins) / bins), 0])
