"""Periodic runs of words: Lyndon arrays by suffix grouping, roots extended into runs.

A run is a maximal stretch of words with smallest period q, here of at least ``min_length`` words and
``times`` periods. Each run contains Lyndon roots: for the order of the words, or for its reverse, the
longest Lyndon word that starts at a root has the period's length. So the Lyndon arrays under both
orders give all candidates.

Lyndon arrays. ``lyndon`` is the first phase of Baier's suffix sorter. Suffixes are grouped by the
longest known prefix they share (at first one word), groups are taken from the largest down, and each
suffix's predecessor (the nearest one before it in a lower group) takes over the group's prefix, once
per member that follows it. When a group's turn comes, its prefix is the longest Lyndon word that
starts at its members. The phase's groups are all that is used, nothing is sorted afterwards.

Runs. In a run of at least three periods a root is followed by another one, with the same entry in
the Lyndon array, so only such roots are candidates; the first one of each stretch is extended to both
sides by longest common extensions, which compare word numbers in doubling steps.

Where to look. Of a run of ``L >= max(min_length, times * q)`` words every window of
``min_length - 2 * min_length / times + 1`` words occurs again one period on or before, so stretches
of words that no repeated window covers hold no run. Windows are told by 64-bit hashes: a collision
only adds words to look at, as runs are decided by the words' numbers. Nothing is left out by this.

A document is handled whole by the task that reads it, so there is no shuffle, no state between rows and
nothing that a group of copies or a hot source could gather in one place; the cost is proportional to a
document's words, but for repeated passages, whose grouping is a loop. Null texts are empty; texts
without words have no runs. Rows are independent: repeated and null ids give a row each. Of other
columns of the input nothing is read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from liftworks.llm.text import DOC_ID, TEXT, binaries

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_LENGTH = 24
TIMES = 3
#: What separates words.
BLANKS = r"[\x20\x09-\x0D]+"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def lyndon(s: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place of ``s`` (numbers from 0)."""
    n = len(s)
    if not n:
        return []
    first: list[list[int]] = [[] for _ in range(max(s) + 1)]
    for i, x in enumerate(s):
        first[x].append(i)
    members = [m for m in first if m]
    width = [1] * len(members)  # of each group's prefix
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members))) + [-1]
    group = [0] * n
    for k, m in enumerate(members):
        for i in m:
            group[i] = k
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # suffixes in groups not yet taken
    out = [0] * n
    g = len(members) - 1
    while g >= 0:
        w = width[g]
        led: list[int] = []  # predecessors, ascending
        times: list[int] = []  # how many members follow each
        for i in members[g]:
            if group[i] != g:
                continue  # has moved to a larger prefix
            out[i] = w
            p, q = before[i], after[i]
            if q < n:
                before[q] = p
            if p >= 0:
                after[p] = q
                if led and led[-1] == p:
                    times[-1] += 1
                else:
                    led.append(p)
                    times.append(1)
        members[g] = []
        if led:
            targets: dict[tuple[int, int], int] = {}
            # larger counts first: each new group goes right above the old one, below larger ones
            order = range(len(led)) if len(set(times)) == 1 else sorted(range(len(led)), key=lambda k: -times[k])
            for k in order:
                p, t = led[k], times[k]
                old = group[p]
                new = targets.get((t, old))
                if new is None:
                    new = targets[t, old] = len(members)
                    members.append([])
                    width.append(width[old] + t * w)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    below[up] = new
                members[new].append(p)
                group[p] = new
        g = below[g]
    return out


def common_after(s: np.ndarray, i: int, j: int) -> int:
    """How many items from ``i`` and from ``j > i`` on are equal."""
    n, done, step = len(s), 0, 32
    while j + done < n:
        k = min(step, n - j - done)
        differ = s[i + done : i + done + k] != s[j + done : j + done + k]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + k, step * 2
    return done


def common_before(s: np.ndarray, i: int, j: int) -> int:
    """How many items right before ``i`` and right before ``j > i`` are equal."""
    done, step = 0, 32
    while done < i:
        k = min(step, i - done)
        differ = (s[i - done - k : i - done] != s[j - done - k : j - done])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + k, step * 2
    return done


def runs_of(s: np.ndarray, min_length: int = MIN_LENGTH, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of ``s``, by start, then period."""
    n = len(s)
    found = set()
    if n < min_length:
        return []
    ranks = np.unique(s, return_inverse=True)[1].ravel()
    for order in (ranks, ranks.max() - ranks):
        size = np.array(lyndon(order.tolist()), dtype=np.int64)
        here = np.arange(n)
        after = np.minimum(here + size, n - 1)
        follows = (here + 2 * size <= n) & (size[after] == size) & (ranks[after] == ranks)
        follows &= ranks[np.minimum(here + 2 * size, n) - 1] == ranks[after - 1]
        reach: dict[int, int] = {}  # end of the last stretch of each period
        for i in np.flatnonzero(follows).tolist():
            q = int(size[i])
            if i + q < reach.get(q, 0):
                continue  # a later root of the same stretch
            start = i - common_before(s, i, i + q)
            length = i + q + common_after(s, i, i + q) - start
            reach[q] = start + length
            if length >= max(min_length, times * q):
                found.add((start, length, q))
    return sorted(found)


def repeated_stretches(
    s: np.ndarray, bounds: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches covered by windows that occur twice in their document.

    ``s`` holds the items of several documents, that of document k from ``bounds[k]`` to ``bounds[k + 1]``.
    """
    none = np.zeros(0, dtype=np.int64)
    sizes = np.diff(bounds)
    starts = np.maximum(sizes - window + 1, 0)  # windows of each document
    if not starts.sum():
        return none, none
    owner = np.repeat(np.arange(len(sizes)), starts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + bounds[owner]
    code = (owner.astype(np.uint64) + np.uint64(1)) * _FOLD
    items = (s.astype(np.uint64) + np.uint64(1)) * _FOLD
    items ^= items >> np.uint64(32)
    for k in range(window):
        code = (code ^ items[at + k]) * _ODD
        code ^= code >> np.uint64(29)
    order = np.argsort(code, kind="stable")
    code = code[order]
    same = code[1:] == code[:-1]
    twice = np.zeros(len(code), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    heads = at[order[twice]]
    edge = np.zeros(len(s) + 1, dtype=np.int64)
    np.add.at(edge, heads, 1)
    np.add.at(edge, heads + window, -1)
    covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    step = np.flatnonzero(covered[1:] != covered[:-1])
    lo, hi = step[::2], step[1::2]
    # stretches of neighbouring documents may touch
    cuts = np.unique(bounds[1:-1])
    inner = cuts[covered[cuts] & covered[cuts + 1]]
    return np.sort(np.concatenate([lo, inner])), np.sort(np.concatenate([hi, inner]))


def _arrays(batch_words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers, each document's own, and the documents' bounds."""
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in batch_words])]).astype(np.int64)
    flat = np.empty(bounds[-1], dtype=np.int64)
    for words, lo, hi in zip(batch_words, bounds[:-1].tolist(), bounds[1:].tolist()):
        numbers: dict[bytes, int] = {}
        flat[lo:hi] = np.fromiter(map(numbers.setdefault, words, count()), np.int64, hi - lo)
    return flat, bounds


def detect(
    docs: DataFrame,
    key: str | Column = DOC_ID,
    text: str | Column = TEXT,
    min_length: int = MIN_LENGTH,
    times: int = TIMES,
) -> DataFrame:
    """(key, runs, collapsed) for every row: runs as (start, length, period) in words, by start, then
    period; ``collapsed`` is the text's words without those that repeat inside a run, joined by one
    space.
    """
    if times < 3 or min_length < times:
        raise ValueError("runs of at least three periods are found")
    window = min_length - 2 * min_length // times + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _pieces(batch):
                words = [t.split() for t in binaries(rows.column(1))]
                flat, bounds = _arrays(words)
                lo, hi = repeated_stretches(flat, bounds, window)
                owner = np.searchsorted(bounds, lo, side="right") - 1
                found: list[list[tuple[int, int, int]]] = [[] for _ in words]
                for d, a, b in zip(owner.tolist(), lo.tolist(), hi.tolist()):
                    shift = a - int(bounds[d])
                    found[d] += [(x + shift, n, q) for x, n, q in runs_of(flat[a:b], min_length, times)]
                kept = []
                for own, runs in zip(words, found):
                    if runs:
                        gone = np.zeros(len(own), dtype=bool)
                        for x, n, q in runs:
                            gone[x + q : x + n] = True
                        own = [own[i] for i in np.flatnonzero(~gone).tolist()]
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        _run_lists(found),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["key", "runs", "collapsed"],
                )

    rows = docs.select(_column(key).alias("key"), _column(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(run, schema)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pieces(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, at least one row each."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy()
    at, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > at and total + n > size:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < batch.num_rows:
        yield batch.slice(at)


def _run_lists(found: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    flat = np.array([r for f in found for r in f], dtype=np.int64).reshape(-1, 3)
    items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(ends), items)


# --- the registered query ---------------------------------------------------------------------


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the query's periodic tails: of every tenth document by the checksum of its
    id, words from a place on repeat the first few after it. Rows without an id stay as they are.
    """
    mark = F.crc32(F.col(DOC_ID).cast("string"))
    words = F.filter(F.split(F.coalesce(TEXT, F.lit("")), BLANKS), lambda w: w != "")
    rows = docs.select(DOC_ID, TEXT, mark.alias("h"))
    edited = (
        rows.select(DOC_ID, TEXT, F.when(F.col("h") % 10 == 0, words).alias("w"), F.expr("h div 10").alias("g"))
        .withColumn("n", F.size("w").cast("long"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    )
    # the first words as they are, then the period over and over
    tail = F.expr("repeat(concat(' ', array_join(slice(w, int(a) + 1, int(p)), ' ')), int((n - a) div p))")
    rest = F.expr("array_join(slice(w, int(a) + 1, int((n - a) % p)), ' ')")
    head = F.expr("array_join(slice(w, 1, int(a)), ' ')")
    return edited.select(
        DOC_ID, F.when(F.col("n") > 0, F.concat_ws(" ", head, tail, rest)).otherwise(F.col(TEXT)).alias(TEXT)
    )


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: its runs' number and digest, the run with the most periods, and the digest of
    its collapsed text."""
    # the first of equal exponents has the smallest start, then the smallest period
    more = "r.length * m.period > m.length * r.period"
    top = F.expr(f"aggregate(slice(runs, 2, size(runs)), runs[0], (m, r) -> if({more}, r, m))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = detect(planted(docs))
    return found.withColumn("top", F.when(F.size("runs") > 0, top)).select(
        F.col("key").alias(DOC_ID),
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
