"""Operator 8: quality rules learned as a decision list.

Statistics of every text are counted in tasks. Sequential covering learns rules from labelled
statistics: a rule is a conjunction of thresholds that is *grown* on one part of the labelled rows
until it holds for no good document or no condition helps, and *pruned* on the other part. Rules
that are not precise there are not used. The list is emitted as one ordered ``CASE WHEN`` over the
statistics, which Spark evaluates for all documents.

The fit reads at most ``MAX_LABELLED`` labelled rows, chosen by a hash of the id; statistics and
verdicts cover all documents. Null texts have no words and fail the base. Without labels, or with
one class only, the list is empty and keeps what passes the base. Null labels and ids are left out
of the fit; repeated rows get one result each; labels repeated for an id count as the worst.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from liftworks.llm.text import binaries
from liftworks.sources import stage

MAX_LABELLED = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
CUTS = 64  # candidate thresholds per statistic
PRECISION = 0.97  # least precision of a rule on the pruning part
BASE_WORDS = 50
BASE_REPEAT_PERCENT = 50

_SPACE = b" \t\n\r\x0b\x0c"
_NOT_CHARS = _SPACE + bytes(range(0x80, 0xC0))  # white space and continuation bytes
#: Fixed value: characters that count as symbols.
_SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct")


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words in 3-word windows found twice or more, and distinct words."""
    n = len(words)
    if n < 4:
        return 0, len(set(words))
    numbers: dict[bytes, int] = {}
    put = numbers.setdefault
    ids = np.fromiter((put(w, len(numbers)) for w in words), np.int64, n)
    m = len(numbers)
    pairs = ids[:-1] * m + ids[1:]
    if m > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * m + ids[2:]
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0, m
    at = np.zeros(n, dtype=bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        at[starts + k] = True
    return int(at.sum()), m


def counts_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated, distinct = repeat_words(words)
    return (
        len(words),
        len(text.translate(None, _NOT_CHARS)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        distinct,
    )


def statistics(docs: DataFrame, key: str | None = None) -> DataFrame:
    """(doc_id, counts) of every document, and the long column ``key`` if one is named."""
    extra = [key] if key else []

    def run(batches):
        for b in batches:
            columns = np.array([counts_of(t) for t in binaries(b.column(1))], dtype=np.int64)
            columns = columns.reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in np.ascontiguousarray(columns.T)], *b.columns[2:]],
                names=["doc_id", *COUNTS, *extra],
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, *extra])
    return docs.select(F.col("doc_id").cast("long"), "text", *extra).mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """Statistics that rules speak of; 0 where there is nothing to divide by."""

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": ratio("word_chars", "n_words"),
        "symbol_share": ratio("n_symbols", "word_chars"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "repeat_share": ratio("n_repeat_words", "n_words"),
        "words_per_line": ratio("n_words", "n_lines"),
        "distinct_share": ratio("n_distinct", "n_words"),
    }


def base_failed() -> Column:
    few = F.col("n_words") < BASE_WORDS
    return few | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value <= threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v >= self.threshold if self.above else v <= self.threshold

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x) for c in self.conditions])

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def _score(covered: np.ndarray, bad: np.ndarray) -> tuple[int, int]:
    p = int((covered & bad).sum())
    return p, int(covered.sum()) - p


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule | None:
    """Add the condition of highest information gain until no good document is covered."""
    covered, conditions = np.ones(len(bad), dtype=bool), []
    p, n = _score(covered, bad)
    while n and p and len(conditions) < MAX_CONDITIONS:
        before, best = np.log2(p / (p + n)), (0.0, None)
        for name, values in x.items():
            inside, hit = values[covered], bad[covered]
            cuts = np.unique(np.quantile(inside[hit], np.linspace(0, 1, CUTS)))
            for above in (True, False):
                for cut in cuts:
                    kept = inside >= cut if above else inside <= cut
                    q, m = int((kept & hit).sum()), int((kept & ~hit).sum())
                    if q:
                        gain = q * (np.log2(q / (q + m)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(name, above, float(cut)))
        if best[1] is None:
            break
        conditions.append(best[1])
        covered &= best[1].holds(x)
        p, n = _score(covered, bad)
    return Rule(tuple(conditions)) if conditions else None


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, int, int]:
    """The shortest beginning of the rule that is best on the pruning part."""
    best = None
    for k in range(1, len(rule.conditions) + 1):
        short = Rule(rule.conditions[:k])
        p, n = _score(short.holds(x), bad)
        worth = (p - n) / (p + n) if p + n else -1.0
        if best is None or worth > best[0]:
            best = (worth, short, p, n)
    return best[1:]


def learn(x: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray) -> list[Rule]:
    """Ordered rules that reject documents; ``grow`` marks the growing part."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES:
        a, b = left & grow, left & ~grow
        if not (bad & a).any():
            break
        rule = _grow({k: v[a] for k, v in x.items()}, bad[a])
        if rule is None:
            break
        rule, p, n = _prune(rule, {k: v[b] for k, v in x.items()}, bad[b])
        if p + n == 0 or p / (p + n) < PRECISION:
            break
        rules.append(rule)
        left &= ~rule.holds(x)
    return rules


def fit(stats: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> list[Rule]:
    """Rules for ``labels`` (doc_id, quality: 0 is bad) over the statistics of their documents."""
    marked = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    n = marked.count()
    share = min(1.0, bound / n) if n else 1.0
    slots = 1 << 40
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(slots)) < int(share * slots)
    columns = features()
    rows = (
        stats.filter(~base_failed())
        .join(marked.filter(drawn), "doc_id")
        .select(
            (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) < 2).alias("grow"),
            (F.col("quality") < 1).alias("bad"),
            *[c.alias(k) for k, c in columns.items()],
        )
        .toPandas()  # at most about ``bound`` rows
        .sort_values([*columns, "bad", "grow"])
    )
    if not len(rows):
        return []
    x = {k: rows[k].to_numpy(dtype=float) for k in columns}
    return learn(x, rows["bad"].to_numpy(bool), rows["grow"].to_numpy(bool))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, 0 if none: one ordered conditional expression."""
    if not rules:
        return F.lit(0)
    whens = " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(rules, 1))
    return F.expr(f"CASE {whens} ELSE 0 END")


def apply(docs: DataFrame, labels: DataFrame, key: str | None = None) -> DataFrame:
    """Counts, base and verdict of every document; ``rule`` is the rule that rejected it or 0.

    ``key`` names a long column of ``docs`` that goes along.
    """
    stats = stage(statistics(docs, key), "statistics")
    rules = fit(stats, labels)
    judged = stats.withColumns(
        {f"__{k}": F.col(k) for k in COUNTS} | {"base_failed": base_failed()}
    )
    judged = judged.withColumns(features()).withColumn("rule", verdict(rules).cast("int"))
    return judged.select(
        "doc_id",
        *[F.col(f"__{k}").alias(k) for k in COUNTS],
        "base_failed",
        "rule",
        (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
        *([key] if key else []),
    )
