"""Newton boosting for the Tweedie deviance over binned features.

Features are binned to bytes once, with cut points from weighted quantile summaries; the bin after the
last holds missing values (null or NaN), and each split learns to which side they go. A tree grows level by
level from histograms of gradients (``trees.Grower``).

Rounds run in one of two ways, which grow the same trees:

* Resident: a stage whose tasks hold their binned rows, margins and nodes in memory, so rounds cost no
  jobs. There are as many tasks as the rows have ``SHARE`` bytes. Several tasks are a barrier stage: per
  level they exchange histograms by ``allGather`` and all grow the same tree. Spark answers such a call
  after one second at the earliest, which is why small inputs take one task and why a share is large.
  After ``keep_every`` rounds the stage ends and writes margins and trees; a lost executor repeats the
  rounds since then. A barrier stage needs all its tasks at once, each with ``RESIDENT_BYTES`` of rows at
  most, and every task reads the histograms of all: ``TASKS`` bounds their number.
* By jobs, for inputs beyond that (or ``tasks=0``): each level is one Spark aggregate of the histograms, and
  margins are written every ``stage_every`` rounds.

``resume`` names a shared folder in which the written rounds stay: a fit with the same settings and rows
goes on from the last of them.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import math
import random
import sys
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from liftworks.operators import summaries, trees
from liftworks.sources import exists, release, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of rows for which another task pays.
SHARE = 128 << 20
#: Tasks of a barrier stage at most.
TASKS = 16
#: Bytes of rows a task of a barrier stage holds at most, about.
RESIDENT_BYTES = 1 << 30
#: Characters of a message to all tasks, times their number.
MESSAGE = 48 << 20

_BINNED = "margin double, label double, weight double, mark bigint, bins binary, trees binary"
_NAMES = [f.split()[0] for f in _BINNED.split(", ")]


@dataclass(frozen=True)
class Settings:
    cuts: tuple[np.ndarray, ...]
    bins: int
    power: float
    rounds: int
    max_depth: int
    rate: float
    penalty: trees.Penalty
    subsample: float
    colsample: float
    seed: int

    def digest(self, *more) -> str:
        parts = (
            [c.tolist() for c in self.cuts], self.bins, self.power, self.max_depth, self.rate, self.penalty,
            self.subsample, self.colsample, self.seed, *more,
        )
        return hashlib.sha256(repr(parts).encode()).hexdigest()[:24]

    def grower(self, turn: int) -> trees.Grower:
        n = len(self.cuts)
        used = list(range(n))
        if self.colsample < 1.0:
            used = sorted(random.Random(self.seed + turn).sample(used, max(1, round(self.colsample * n))))
        return trees.Grower(self.cuts, used, self.penalty, self.bins)

    def drawn(self, mark: np.ndarray, turn: int) -> np.ndarray | None:
        """Which rows a round uses; None for all. Depends on a row's mark and the round only."""
        if self.subsample >= 1.0:
            return None
        x = mark.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (self.seed + turn + 1)) % 2**64)
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
        return (x >> np.uint64(11)) < np.uint64(int(self.subsample * 2**53))


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, power: float):
    """First and second derivative of the Tweedie deviance half in the margin, per row."""
    low, high = np.exp((1.0 - power) * margin), np.exp((2.0 - power) * margin)
    return weight * (high - label * low), weight * ((2.0 - power) * high - (1.0 - power) * label * low)


class Rows:
    """Binned rows of a batch or of a task: bins as (feature, row)."""

    def __init__(self, batches: Sequence[pa.RecordBatch], width: int):
        column = lambda k: np.concatenate([b.column(k).to_numpy() for b in batches] or [[]])
        self.margin, self.label, self.weight = (column(k).astype(float) for k in range(3))
        self.mark = column(3).astype(np.int64)
        flat = [np.frombuffer(x, np.uint8) for b in batches for x in (_joined(b.column(4)),)]
        whole = np.concatenate(flat) if flat else np.zeros(0, np.uint8)
        self.bins = np.ascontiguousarray(whole.reshape(-1, width).T)

    @classmethod
    def unpacked(cls, batches: Sequence[pa.RecordBatch], width: int) -> Rows:
        """The rows of batches that ``_packed`` made."""
        rows = cls([], width)
        whole = lambda k, kind: np.frombuffer(b"".join(_joined(b.column(k)) for b in batches), kind)
        rows.margin, rows.label, rows.weight = (whole(k, np.float64).copy() for k in range(3))
        rows.mark = whole(3, np.int64)
        rows.bins = np.ascontiguousarray(whole(4, np.uint8).reshape(-1, width).T)
        return rows

    def batches(self, size: int = 10_000) -> Iterator[pa.RecordBatch]:
        width = len(self.bins)
        for at in range(0, len(self.margin), size):
            part = np.ascontiguousarray(self.bins[:, at : at + size].T)
            n = len(part)
            items = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)[: n + 1].tobytes()), pa.py_buffer(part.tobytes())]
            )
            plain = [pa.array(x[at : at + size]) for x in (self.margin, self.label, self.weight, self.mark)]
            yield pa.RecordBatch.from_arrays([*plain, items, pa.nulls(n, pa.binary())], names=_NAMES)


def _joined(column) -> bytes:
    return b"".join(column.to_pylist())


def binned(rows: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], start: float, bins: int) -> DataFrame:
    """Start margins, marks, and the bins of all features as one byte string.

    ``rows`` has the features, then label, weight, offset (of the margin) and mark.
    """
    n = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            out = np.zeros((n, b.num_rows), dtype=np.uint8)
            for k, c in enumerate(cuts):
                x = b.column(k).to_numpy(zero_copy_only=False).astype(float)
                out[k] = np.where(np.isnan(x), bins, np.searchsorted(c, x, side="left"))
            some = Rows([], n)
            some.margin = b.column(n + 2).to_numpy() + start
            some.label, some.weight, some.mark = (b.column(n + k).to_numpy() for k in (0, 1, 3))
            some.bins = out
            yield from some.batches(b.num_rows)

    return rows.mapInArrow(run, _BINNED)


def fit(
    current: DataFrame,
    settings: Settings,
    tasks: int | None,
    stage_every: int,
    keep_every: int,
    resume: str | None = None,
) -> list[trees.Tree]:
    """Trees for the rows of ``current``, a staged table as ``binned`` makes it, which is released."""
    spark, width = current.sparkSession, len(settings.cuts)
    size = current.count() * (width + 48)
    if tasks is None:
        tasks = min(spark.sparkContext.defaultParallelism, TASKS, size // SHARE + 1)
    resident = tasks and size <= tasks * RESIDENT_BYTES
    step = keep_every if resident else stage_every
    work = _resident if resident else _by_jobs
    fitted: list[trees.Tree] = []
    if resume:
        resume = f"{resume.rstrip('/')}/{settings.digest(current.count())}"
        # the last rounds written; a folder counts once Spark has committed it
        for done in range(step * (settings.rounds // step), 0, -step):
            if exists(spark, f"{resume}/rounds-{done:06d}/_SUCCESS"):
                release(current)
                current = spark.read.schema(_BINNED).parquet(f"{resume}/rounds-{done:06d}")
                fitted = _trees_of(current)
                break
    while len(fitted) < settings.rounds:
        count = min(step, settings.rounds - len(fitted))
        after = work(current, settings, fitted, count, tasks)
        if not resume and len(fitted) + count == settings.rounds:
            new = stage(after(False), "boosting")  # no round follows that needs the margins
            fitted = _trees_of(new)
            release(new)
            break
        after = after(True)
        if resume:
            path = f"{resume}/rounds-{len(fitted) + count:06d}"
            after.write.mode("overwrite").parquet(path)
            new = spark.read.schema(_BINNED).parquet(path)
        else:
            new = stage(after, "boosting")
        fitted = _trees_of(new)
        release(current)
        current = new
    release(current)
    return fitted


def _trees_of(written: DataFrame) -> list[trees.Tree]:
    """All trees so far; a written table has one row of them."""
    text = written.filter("trees is not null").select("trees").first()[0]
    return [trees.Tree(tuple(trees.Node(*n) for n in nodes)) for nodes in json.loads(bytes(text))]


def _text_of(fitted: list[trees.Tree]) -> bytes:
    return json.dumps([[astuple(n) for n in t.nodes] for t in fitted]).encode()


def _tree_row(fitted: list[trees.Tree]) -> pa.RecordBatch:
    kinds = [pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary()]
    values = [None] * 5 + [_text_of(fitted)]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=_NAMES)


# --- resident rounds --------------------------------------------------------------------------


def gathered(context, sums: np.ndarray) -> np.ndarray:
    """Sums over all tasks, added in the order of the tasks, so that all get the same bits."""
    flat, tasks = sums.ravel(), len(context.getTaskInfos())
    out = np.zeros(len(flat))
    size = max(1, MESSAGE // tasks // 12)  # eight bytes are eleven characters at most
    for at in range(0, len(flat), size):
        part = flat[at : at + size]
        message = base64.b64encode(zlib.compress(part.tobytes(), 1)).decode()
        for said in context.allGather(message):
            out[at : at + size] += np.frombuffer(zlib.decompress(base64.b64decode(said)))
    return out.reshape(sums.shape)


def grown(rows: Rows, settings: Settings, turn: int, add: Callable[[np.ndarray], np.ndarray]):
    """One round's grower and the leaf of each row; ``add`` sums histograms over all tasks."""
    grower = settings.grower(turn)
    at = np.zeros(len(rows.margin), dtype=np.int64)
    g, h = gradients(rows.margin, rows.label, rows.weight, settings.power)
    drawn = settings.drawn(rows.mark, turn)
    for _ in range(settings.max_depth):
        if not grower.open:
            break
        slot = grower.slots()[at]
        if drawn is not None:
            slot = np.where(drawn, slot, -1)
        grower.grow(add(trees.histograms(rows.bins, slot, grower.used, grower.shape, g, h)))
        at = grower.step(rows.bins, at)
    return grower, at


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one row of bytes, so that few tasks needn't take their rows one by one."""
    for b in batches:
        if b.num_rows:
            plain = [b.column(k).to_numpy(zero_copy_only=False).tobytes() for k in range(4)]
            columns = [pa.array([x], pa.binary()) for x in (*plain, _joined(b.column(4)))]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES[:5])


_PACKED = ", ".join(f"{n} binary" for n in _NAMES[:5])


def _resident(
    current: DataFrame, settings: Settings, fitted: list[trees.Tree], count: int, tasks: int
) -> Callable[[bool], DataFrame]:
    """The trees after ``count`` more rounds, with the margins of all rows if asked for."""
    width, first = len(settings.cuts), len(fitted)

    def after(margins: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = BarrierTaskContext.get() if tasks > 1 else None
            rows = Rows.unpacked([b for b in batches if b.num_rows], width)
            done = list(fitted)
            for turn in range(first, first + count):
                add = functools.partial(gathered, context) if context else lambda sums: sums
                grower, at = grown(rows, settings, turn, add)
                rows.margin += grower.values(settings.rate)[at]
                done.append(grower.tree(settings.rate))
            if TaskContext.get().partitionId() == 0:
                yield _tree_row(done)
            if margins:
                yield from rows.batches()

        rows = current.filter("trees is null").mapInArrow(_packed, _PACKED).repartition(tasks)
        if tasks == 1:
            return rows.mapInArrow(run, _BINNED)
        # shuffled on: Spark runs a barrier stage again only if no output has been committed from it
        return rows.mapInArrow(run, _BINNED, barrier=True).repartition(tasks)

    return after


# --- rounds by jobs ---------------------------------------------------------------------------


def _by_jobs(
    current: DataFrame, settings: Settings, fitted: list[trees.Tree], count: int, tasks: int
) -> Callable[[bool], DataFrame]:
    """As ``_resident``."""
    rows, width = current.filter("trees is null"), len(settings.cuts)
    pending: list[tuple[trees.Grower, np.ndarray]] = []
    done = list(fitted)
    for turn in range(len(fitted), len(fitted) + count):
        grower = settings.grower(turn)
        for _ in range(settings.max_depth):
            if not grower.open:
                break
            grower.grow(_level(rows, settings, turn, pending, grower))
        pending.append((grower, grower.values(settings.rate)))
        done.append(grower.tree(settings.rate))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from _moved(b, width, pending).batches()

    trees_row = current.sparkSession.createDataFrame([(None,) * 5 + (_text_of(done),)], _BINNED)
    return lambda margins: rows.mapInArrow(run, _BINNED).union(trees_row) if margins else trees_row


def _moved(batch: pa.RecordBatch, width: int, pending) -> Rows:
    """Rows with the margins after the rounds that are not yet written."""
    rows = Rows([batch], width)
    for grower, values in pending:
        rows.margin += values[grower.place(rows.bins)]
    return rows


def _level(current: DataFrame, settings: Settings, turn: int, pending, grower: trees.Grower) -> np.ndarray:
    """Histograms of the wanted nodes, summed by Spark."""
    shape, width = grower.shape, len(settings.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape)
        for b in batches:
            if not b.num_rows:
                continue
            rows = _moved(b, width, pending)
            g, h = gradients(rows.margin, rows.label, rows.weight, settings.power)
            slot = grower.slots()[grower.place(rows.bins)]
            drawn = settings.drawn(rows.mark, turn)
            if drawn is not None:
                slot = np.where(drawn, slot, -1)
            sums += trees.histograms(rows.bins, slot, grower.used, shape, g, h)
        cells = sums.reshape(-1, 3)
        at = np.flatnonzero(cells[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *[pa.array(cells[at, k]) for k in range(3)]], names=["cell", "n", "g", "h"]
        )

    parts = current.mapInArrow(run, "cell long, n double, g double, h double").groupBy("cell")
    out = np.zeros((math.prod(shape[:3]), 3))
    # at most nodes x features x bins rows
    for r in parts.agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        out[r["cell"]] = r["n"], r["g"], r["h"]
    return out.reshape(shape)


def cut_points(rows: DataFrame, features: Sequence[str], weight: str, max_bins: int) -> list[np.ndarray]:
    """Cut points of all features from one job, by weighted rank."""
    found = summaries.summarise(rows, features, weight, max(summaries.SIZE, 32 * max_bins))
    return [summaries.cuts(s, max_bins) for s in found]


def mark_of(key: str | None) -> Column:
    """What row draws depend on."""
    return F.xxhash64(F.col(key).cast("string")) if key else F.lit(0).cast("long")
