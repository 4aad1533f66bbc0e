"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. Stages
write and reread Parquet in between. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from liftworks.llm import nearcopies, ordinal, packing, rules, suffixes
from liftworks.llm.rows import free_name, numbered
from liftworks.sources import stage

ORACLE_SQL = None  # the learned stages and the index cannot be said in SQL


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _kept(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows of ``docs`` that ``judge`` keeps, each by a number of its own: ids may be null or repeated."""
    row = free_name(docs)
    docs = numbered(docs, row)
    kept = judge(docs, row).filter("kept").select(row)
    return docs.join(kept, row, "left_semi").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the learned rules."""
    labels = _labels(spark, sf_dir)
    return _kept(docs, lambda d, row: rules.apply(d, labels, key=row))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely of the top grade than not."""
    labels = _labels(spark, sf_dir)
    return _kept(docs, lambda d, row: ordinal.select(d, labels, key=row))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (five-word Jaccard of 0.8 or more)."""
    return nearcopies.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere too."""
    return suffixes.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in length buckets and batches."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
