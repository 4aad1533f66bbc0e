"""Operator 7: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector of hashed text features shared
by all grades, and ordered thresholds. Expected grade and tail probabilities follow from it.

Features of a text are its distinct lower-cased words: each gives its letters and its punctuation,
hashed to ``BUCKETS``, present or not. Features in fewer than
``LEAST_DOCS`` documents of the fit, or whose grades look like chance (``LEAST_Z``), have no weight.

The fit reads at most about ``MAX_LABELLED`` rated documents, chosen by a hash of the id; each round
tasks compute gradients over their part and the driver adds one vector per task. Scores cover whole
texts of all documents.

Null and empty texts have no features; they get the probabilities of the thresholds. Null ids or
grades are left out of the fit, repeated rows are scored each. Without rated documents all grades
are equally likely and everything is kept.
"""

from __future__ import annotations

import zlib
from itertools import chain
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from liftworks.llm.text import binaries, words_of
from liftworks.sources import stage

BUCKETS = 1 << 17
MAX_LABELLED = 16_000
LEAST_DOCS = 10
LEAST_Z = 10.0
ROUNDS = 80
RATE = 0.2
RIDGE = 1e-3
MEMO = 400_000  # words whose weight a task remembers

#: ASCII letters and digits, and bytes of other letters: what is left of a word's letters.
_PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())
_LETTERS = bytes(b for b in range(256) if b not in set(_PUNCTUATION))


def features_of(word: bytes) -> tuple[int, ...]:
    """Buckets of a word: its letters, its punctuation marks, each if there are any."""
    letters, marks = word.translate(None, _PUNCTUATION), word.translate(None, _LETTERS)
    out = []
    if letters:
        out.append(zlib.crc32(letters) % BUCKETS)
    if marks:
        out.append(zlib.crc32(marks, 1) % BUCKETS)
    return tuple(out)


@dataclass(frozen=True)
class Model:
    thresholds: np.ndarray  # ascending, one less than grades
    weights: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. of each score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - scores[:, None], -60, 60)))


def telling(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features whose documents are graded otherwise than chance: for one of the tails, the count
    of documents in it is ``LEAST_Z`` standard deviations or more from its expectation."""
    n = found.sum(axis=1)
    best = np.zeros(len(found))
    for k in range(1, len(counts)):
        share = counts[k:].sum() / counts.sum()
        spread = np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
        if 0 < share < 1:
            best = np.maximum(best, np.abs(found[:, k:].sum(axis=1) - n * share) / spread)
    return (n >= LEAST_DOCS) & (best >= LEAST_Z)


def _rated(docs: DataFrame, ratings: DataFrame, bound: int) -> DataFrame:
    marked = ratings.filter("doc_id is not null and grade is not null")
    marked = marked.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    n = marked.count()
    slots = 1 << 40
    share = min(1.0, bound / n) if n else 1.0
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(slots)) < int(share * slots)
    chosen = F.broadcast(marked.filter(drawn))  # at most about ``bound`` rows

    def run(batches):
        for b in batches:
            rows = []
            for text, grade in zip(binaries(b.column(0)), b.column(1).to_pylist()):
                found = [f for w in set(words_of(text)) for f in features_of(w)]
                rows.append((grade, np.unique(np.array(found, dtype=np.int32)).tobytes()))
            columns = list(zip(*rows)) or [[], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary()))],
                names=["grade", "at"],
            )

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(chosen, "doc_id")
    return joined.select("text", F.col("grade").cast("int")).mapInArrow(
        run, "grade int, at binary"
    )


def _matrix(batches):
    """Features of a part as flat arrays, row number and feature; and the grades."""
    grades, at = [], []
    for b in batches:
        for g, a in zip(*[c.to_pylist() for c in b.columns]):
            grades.append(g)
            at.append(np.frombuffer(a, np.int32))
    if not grades:
        return None
    return np.repeat(np.arange(len(grades)), [len(a) for a in at]), np.concatenate(at), np.array(grades)


def fit(
    docs: DataFrame, ratings: DataFrame, grades: int, rounds: int = ROUNDS, bound: int = MAX_LABELLED
) -> Model:
    """Model for ``ratings`` (doc_id, grade from 0 to grades - 1) of ``docs``."""
    parts = 4
    rated = _rated(docs, ratings, bound).groupBy("at").agg(F.min("grade").alias("grade"))
    # copies count once; rows are in one order, so that sums are the same in every run
    rated = rated.select("grade", "at").repartition(parts, "at").sortWithinPartitions("at")
    data = stage(rated, "rated")
    counts = np.zeros(grades)
    for row in data.groupBy("grade").count().collect():  # one row per grade
        counts[row["grade"]] += row["count"]
    if not counts.sum():
        even = np.arange(1, grades) / grades
        return Model(np.log(even / (1 - even)), np.zeros(BUCKETS))
    below = np.cumsum(counts + 0.5)[:-1] / (counts + 0.5).sum()
    thresholds = np.log(below / (1 - below))

    def seen(batches):
        m = _matrix(batches)
        if m:
            rows, at, grade = m
            found = np.bincount(at * grades + grade[rows], minlength=BUCKETS * grades)
            found = found.astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["n"])

    found = sum(np.frombuffer(r[0], np.int32) for r in data.mapInArrow(seen, "n binary").collect())
    used = np.flatnonzero(telling(found.reshape(BUCKETS, grades), counts))
    place = np.full(BUCKETS, -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    w, low, steps = np.zeros(len(used)), thresholds[0], np.log(np.diff(thresholds) + 1e-3)
    flat = np.concatenate([w, [low], steps])
    total, m1, m2 = counts.sum(), np.zeros_like(flat), np.zeros_like(flat)

    def unpack(flat):
        rest = flat[len(used) :]
        return flat[: len(used)], np.cumsum(np.concatenate([[rest[0]], np.exp(rest[1:])]))

    for k in range(1, rounds + 1):
        w, thresholds = unpack(flat)

        def gradients(batches, w=w, thresholds=thresholds):
            m = _matrix(batches)
            if not m:
                return
            rows, at, grade = m
            kept = place[at] >= 0
            rows, at = rows[kept], place[at[kept]]
            score = np.bincount(rows, weights=w[at], minlength=len(grade))
            edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
            upper, lower = (1 / (1 + np.exp(-np.clip(edges[grade + i] - score, -60, 60))) for i in (1, 0))
            likely = np.maximum(upper - lower, 1e-12)
            du, dl = upper * (1 - upper) / likely, lower * (1 - lower) / likely
            by_score = dl - du  # of the log likelihood
            g = np.bincount(at, weights=by_score[rows], minlength=len(w))
            t = np.zeros(len(thresholds))
            inner = grade < len(thresholds)
            np.add.at(t, grade[inner], du[inner])
            np.add.at(t, grade[grade > 0] - 1, -dl[grade > 0])
            out = np.concatenate([g, t])
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["g"])

        g = sum(np.frombuffer(r[0]) for r in data.mapInArrow(gradients, "g binary").collect())
        t = g[len(used) :]
        later = np.cumsum(t[::-1])[::-1]  # a step moves all thresholds above it
        full = np.concatenate([g[: len(used)], [later[0]], later[1:] * np.exp(flat[len(used) + 1 :])])
        full = full / total
        full[: len(used)] -= RIDGE * flat[: len(used)]
        m1, m2 = 0.9 * m1 + 0.1 * full, 0.99 * m2 + 0.01 * full**2
        flat = flat + RATE * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-8) / np.sqrt(k)
    w, thresholds = unpack(flat)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(thresholds, weights)


def score(docs: DataFrame, model: Model, key: str | None = None) -> DataFrame:
    """(doc_id, expected_grade, p_grade_1, p_grade_2, ...) of every document, and the long column
    ``key`` if one is named."""
    grades = len(model.thresholds) + 1
    extra = [key] if key else []
    names = ["doc_id", "expected_grade", *[f"p_grade_{k}" for k in range(1, grades)]]

    def run(batches):
        class Used(dict):
            def __missing__(self, word):
                if len(self) > MEMO:
                    self.clear()
                found = self[word] = tuple(f for f in features_of(word) if weights[f])
                return found

        weights, used = model.weights.tolist(), Used()
        for b in batches:
            scores = np.zeros(b.num_rows)
            for i, text in enumerate(binaries(b.column(1))):
                found = set(chain.from_iterable(map(used.__getitem__, set(words_of(text)))))
                scores[i] = sum(weights[f] for f in sorted(found))
            tails = model.tails(scores)
            columns = [tails.sum(axis=1), *np.ascontiguousarray(tails.T)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in columns], *b.columns[2:]], names=[*names, *extra]
            )

    kinds = [f"{c} double" for c in names[1:]] + [f"{c} long" for c in extra]
    schema = "doc_id long, " + ", ".join(kinds)
    return docs.select(F.col("doc_id").cast("long"), "text", *extra).mapInArrow(run, schema)


def grade_of() -> Column:
    """Grade of a labelled document: 0 toxic, 1 of low quality, 2 good."""
    return F.when(F.col("toxic") > 0, 0).when(F.col("quality") < 1, 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 2
    )


def select(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, key: str | None = None
) -> DataFrame:
    """Scores of all documents, ``kept`` where the top grade has probability ``least`` or more.

    ``key`` names a long column of ``docs`` that goes along.
    """
    ratings = labels.select("doc_id", grade_of().alias("grade"))
    model = fit(docs, ratings, 3)
    kept = (F.col("p_grade_2") >= least) | F.lit(not model.weights.any())
    return score(docs, model, key).withColumn("kept", kept)
