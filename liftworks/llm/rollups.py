"""Operator 4: token counts kept by deltas.

A rollup holds additive totals (documents, tokens, characters) by source, language and tokenizer
version. Changes come in batches of signed rows: an insert counts +1, a delete -1, a revised count
is a delete of the old and an insert of the new row. A batch is summed before anything moves, and
written as one small table under its own name. It counts once its write has succeeded (Spark's
``_SUCCESS`` file); a batch that failed halfway is written again, one that has succeeded is not, so
that sending a batch twice changes nothing. ``compact`` folds batches into one table, beside which a
small table lists the batches it holds; readers ignore the folded ones. The list is written first and
the fold counts once it is there itself, so a fold lost halfway changes nothing. Any number of batches
can be folded.

Null sources, languages and versions are groups of their own, null counts add nothing. Groups whose
documents and sums are all zero are left out of totals. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from liftworks.sources import fresh_dir, stage

KEYS = ["source", "lang", "version"]
SUMS = ["n_docs", "n_tokens", "n_chars"]
_LIST = "fold string, batch string"
_SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long"


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Delta rows of ``rows`` (source, lang, version, n_tokens, n_chars): ``sign`` +1 or -1."""
    return rows.select(
        *[F.col(k).cast("string").alias(k) for k in KEYS],
        F.lit(sign).cast("long").alias("n_docs"),
        *[(sign * F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in SUMS[1:]],
    )


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


class Rollup:
    """Totals under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_dir(spark, "rollup")

    def _files(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _committed(self) -> dict[str, list[str]]:
        """Committed tables and the batches each holds."""
        fs, path = self._files()
        if not fs.exists(path(self.path)):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path)) if s.isDirectory()]
        done = [n for n in names if fs.exists(path(f"{self.path}/{n}/_SUCCESS"))]
        out = {n: [n[5:]] for n in done if n.startswith("batch")}
        folds = [n for n in done if n.startswith("fold")]
        if folds:
            lists = self.spark.read.schema(_LIST).parquet(*[f"{self.path}/list{n[4:]}" for n in folds])
            for r in lists.groupBy("fold").agg(F.collect_list("batch").alias("held")).collect():  # names only
                out[r["fold"]] = sorted(r["held"])
        return out

    def _current(self) -> list[str]:
        """Tables that count: the widest fold of every batch, or the batch itself."""
        held, out = set(), []
        committed = self._committed()
        for name, batches in sorted(committed.items(), key=lambda x: (-len(x[1]), x[0])):
            if not held & set(batches):
                held |= set(batches)
                out.append(name)
        return out

    def batches(self) -> set[str]:
        return {b for held in self._committed().values() for b in held}

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch; False if it had been committed before."""
        if not re.fullmatch(r"[A-Za-z0-9_-]{1,64}", batch):
            raise ValueError("a batch name is 1 to 64 letters, digits, - or _")
        if batch in self.batches():
            return False
        summed(deltas).write.mode("overwrite").parquet(f"{self.path}/batch{batch}")
        return True

    def compact(self) -> None:
        """Fold the committed batches into one table; a second run over the same ones is the same."""
        committed, names = self._committed(), self._current()
        if len(names) < 2:
            return
        held = sorted({b for n in names for b in committed[n]})
        mark = hashlib.sha256("\n".join(held).encode()).hexdigest()
        listed = self.spark.createDataFrame([(f"fold{mark}", b) for b in held], _LIST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/list{mark}")
        self._read(names).write.mode("overwrite").parquet(f"{self.path}/fold{mark}")

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], _SCHEMA)
        return summed(self.spark.read.schema(_SCHEMA).parquet(*[f"{self.path}/{n}" for n in names]))

    def totals(self) -> DataFrame:
        some = [F.col(c) != 0 for c in SUMS]
        return self._read(self._current()).filter(some[0] | some[1] | some[2])


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, words, chars, repeat): counts of every document; ``repeat`` numbers
    the rows of equal text hash and length from 1."""
    text = F.coalesce("text", F.lit(""))
    words = F.expr(r"regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')").cast("long")
    return docs.select(
        "doc_id",
        "source",
        "lang",
        words.alias("words"),
        F.char_length(text).cast("long").alias("chars"),
        F.md5(text).alias("digest"),
    )


def replay(docs: DataFrame) -> DataFrame:
    """Totals of a corpus that was inserted, lost its exact copies, and had a tokenizer revised.

    Batches: all documents are inserted under version v1 (tokens are words). Copies are deleted: of
    documents with the same text, all but the smallest doc_id (null ids are never the smallest, and
    stay if alone). Version v2 (a token for four characters, rounded up) is inserted for what is
    left. Documents of over 1,000 words get v1 counts revised to words plus one end token. The
    delete batch and the revision are sent twice, and batches are folded midway.
    """
    spark = docs.sparkSession
    rows = stage(counted(docs), "counted")
    v1 = rows.withColumns({"version": F.lit("v1"), "n_tokens": F.col("words"), "n_chars": F.col("chars")})
    first = stage(rows.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts")
    joined = v1.join(first, "digest")
    is_copy = F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first"))
    copies, kept = joined.filter(is_copy), joined.filter(~is_copy)
    v2 = kept.withColumns({"version": F.lit("v2"), "n_tokens": F.ceil(F.col("chars") / 4)})
    long = kept.filter("words > 1000")
    revised = long.withColumn("n_tokens", F.col("words") + 1)
    rollup = Rollup(spark)
    rollup.commit("insert", signed(v1, 1))
    for _ in range(2):
        rollup.commit("delete-copies", signed(copies, -1))
    rollup.compact()
    rollup.commit("insert-v2", signed(v2, 1))
    for _ in range(2):
        rollup.commit("revise-long", signed(long, -1).union(signed(revised, 1)))
    return rollup.totals()
