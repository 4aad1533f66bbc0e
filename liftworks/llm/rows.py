"""Numbers for rows whose doc_ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from liftworks.sources import stage


def numbered(docs: DataFrame, name: str = "id") -> DataFrame:
    """``docs`` with a number of each row's own: doc_id where that is unique, else a row number."""
    own = F.col("doc_id").cast("long")
    seen = docs.agg(F.count(F.lit(1)).alias("rows"), F.count(own).alias("ids")).first()
    distinct = docs.select(own).distinct().count() if seen["rows"] == seen["ids"] else -1
    if distinct == seen["rows"]:
        return docs.withColumn(name, own)
    # written, since row numbers are not the same if an executor is lost
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def free_name(docs: DataFrame, name: str = "__row") -> str:
    """``name``, with underscores before it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
