"""Tables laid out by the key they are joined on.

Policies, folds, premiums and contributions meet on one key again and again. A keyed table is shuffled by
that key once, when it is written; joins of keyed tables then read bucket beside bucket, and any number of
them needs no exchange.

Keys that would fill a bucket of their own are *hot*. A frequent-items sketch finds them in the pass that
counts the rows; their rows are kept aside with a number each, so that a join spreads the hot side over
tasks and repeats the other side's few rows. Rows without a key lie apart: they match nothing. Which keys
are hot changes the layout only, never the rows of a join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from liftworks.sources.staging import fresh_dir, stage

#: Rows that a key may have at least before it counts as hot.
HOT_ROWS = 100_000
_SALT, _AT, _HIT = "__keyed_salt", "__keyed_at", "__keyed_hit"


@dataclass(frozen=True)
class Keyed:
    """``rows`` are bucketed by ``key``, ``aside`` holds those of the ``hot`` keys, ``unkeyed`` those without."""

    key: str
    buckets: int
    rows: DataFrame
    aside: DataFrame
    unkeyed: DataFrame
    hot: tuple = ()

    def _others(self, keys: set) -> Column | None:
        """Condition on rows of ``keys`` that are not set aside here."""
        here = sorted(keys - set(self.hot))
        return F.col(self.key).isin(here) if here else None

    def calm(self, keys: set) -> DataFrame:
        """Bucketed rows of all keys but ``keys``."""
        there = self._others(keys)
        return self.rows if there is None else self.rows.filter(~there)

    def heavy(self, keys: set) -> DataFrame:
        """Rows of ``keys``, numbered if they are hot here."""
        there = self._others(keys)
        if there is None:
            return self.aside
        few = self.rows.filter(there).withColumn(_SALT, F.lit(0).cast("long"))
        return self.aside.unionByName(few)


def hot_keys(df: DataFrame, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> list:
    """Keys with more rows than an even bucket and ``hot_rows``; fewer than ``2 * buckets``.

    The sketch tracks eight items a bucket, so its estimates, which are never too low, exceed a count by
    less than half an even bucket.
    """
    col = f"`{key}`"
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({col}, {2 * buckets}, {8 * buckets})").alias("top")
    )
    row = found.first()
    least = max(row["n"] / buckets, hot_rows)
    return sorted(t["item"] for t in row["top"] or [] if t["count"] > least)


def keyed(
    df: DataFrame, key: str, buckets: int | None = None, hot_rows: int = HOT_ROWS, label: str = "keyed"
) -> Keyed:
    """``df`` written by ``key``. Its key column is read once more than the rest: stage what is costly."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if clash := {_SALT, _AT, _HIT} & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    hot = hot_keys(df, key, buckets, hot_rows)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    name = f"liftworks_keyed_{uuid.uuid4().hex}"
    (
        df.filter(F.col(key).isNotNull() & ~is_hot)
        .repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", fresh_dir(spark, label))
        .saveAsTable(name)
    )
    rows = spark.table(name)
    rows.count()  # resolves the files, so the name is needed no more
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files are the shared folder's
    numbered = df.filter(is_hot).withColumn(_SALT, F.monotonically_increasing_id())
    aside = stage(numbered, f"{label}-hot") if hot else numbered.limit(0)
    return Keyed(key, buckets, rows, aside, df.filter(F.col(key).isNull()), tuple(hot))


def join_keyed(first: Keyed, *others: Keyed, how: str = "inner") -> DataFrame:
    """Joins ``first`` with each of ``others`` on their key, without an exchange of calm rows.

    ``how`` is ``inner`` or ``left``. Columns other than the key must have names of their own; keys may
    repeat on every side.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    key, tables = first.key, (first, *others)
    for other in others:
        if (other.key, other.buckets) != (key, first.buckets):
            raise ValueError("keyed tables must share their key and number of buckets")
        if other.rows.schema[key].dataType != first.rows.schema[key].dataType:
            raise ValueError(f"types of {key} differ")
    names = [c for t in tables for c in t.rows.columns if c != key]
    if clash := {c for c in names if names.count(c) > 1}:
        raise ValueError(f"columns on several sides: {sorted(clash)}")

    keys = set().union(*[t.hot for t in tables])
    out = reduce(lambda a, b: a.join(b, key, how), [t.calm(keys) for t in tables])
    if keys:
        heavy = first.heavy(keys)
        for other in others:
            heavy = _spread(heavy, other.heavy(keys), key, other.hot, first.buckets, how)
        out = out.unionByName(heavy.drop(_SALT))
    if how == "left":
        out = out.unionByName(first.unkeyed, allowMissingColumns=True)
    return out


def _spread(left: DataFrame, right: DataFrame, key: str, right_hot: tuple, parts: int, how: str) -> DataFrame:
    """Join of hot keys: the right side is dealt into parts where it is hot, else the left side is.

    The side that isn't dealt is repeated in every part. A key that is hot on the right has rows there, so
    its left rows need no outer join.
    """
    dealt = F.col(key).isin(*right_hot) if right_hot else F.lit(False)
    one = F.array(F.pmod(F.xxhash64(_SALT), F.lit(parts)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    a = left.withColumn(_AT, F.explode(F.when(dealt, every).otherwise(one)))
    b = right.withColumn(_AT, F.explode(F.when(dealt, one).otherwise(every)))
    b = b.withColumn(_HIT, F.lit(True)).withColumnRenamed(_SALT, f"{_SALT}_r")
    joined = a.join(b, [key, _AT], how).filter(~dealt | F.col(_HIT).isNotNull())
    salt = F.xxhash64(_SALT, f"{_SALT}_r")  # spread if either side is
    return joined.withColumn(_SALT, salt).drop(_AT, _HIT, f"{_SALT}_r")
