"""Keyed tables: joins without an exchange, hot keys, null keys."""

import pytest
from pyspark.sql import functions as F

from liftworks.plans import bindings as b
from liftworks.sources import join_keyed, keyed
from liftworks.sources.keyed import hot_keys
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark):
    """A third of the rows have key 7, some none; the values tell the rows apart."""
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 == 0, 7).when(i % 101 == 1, None).otherwise(i % 400).cast("long").alias("k"), i.alias("a")
    )


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_chained_joins_need_no_exchange(spark, no_broadcast):
    key = "vin_date"
    master = keyed(b.master(spark, SF), key, 4)
    aux = keyed(b.aux(spark, SF), key, 4)
    premium = keyed(b.premium(spark, SF).withColumnRenamed("o_orderkey", key), key, 4)
    joined = join_keyed(master, aux, premium)
    assert "Exchange" not in plan(joined, "simple")
    assert "Exchange" not in plan(joined.groupBy(key).count(), "simple")
    plain = b.master(spark, SF).join(b.aux(spark, SF), key).join(
        b.premium(spark, SF).withColumnRenamed("o_orderkey", key), key
    )
    assert rows_of(joined) == rows_of(plain)


def test_hot_keys_are_found(spark):
    df = skewed(spark)
    assert hot_keys(df, "k", 4, hot_rows=100) == [7]
    assert hot_keys(df, "k", 4, hot_rows=5000) == []
    assert hot_keys(df.limit(0), "k", 4, hot_rows=0) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_join_like_others(spark, no_broadcast, how):
    left = skewed(spark)
    i = F.col("id")
    once = spark.range(390).select(i.alias("k"), (i * 2).alias("b"))
    often = spark.range(60).select(F.when(i % 2 == 0, 7).when(i % 9 == 1, 11).otherwise(i).alias("k"), i.alias("c"))
    tables = [keyed(t, "k", 4, hot_rows=n) for t, n in ((left, 100), (once, 100), (often, 10))]
    assert [t.hot for t in tables] == [(7,), (), (7,)]
    want = left.join(once, "k", how).join(often, "k", how)
    assert rows_of(join_keyed(*tables, how=how)) == rows_of(want)
    # hot on the right alone
    want = once.join(left, "k", how).join(often, "k", how)
    assert rows_of(join_keyed(tables[1], tables[0], tables[2], how=how)) == rows_of(want)


def test_hot_rows_are_dealt_over_the_parts(spark, no_broadcast):
    left = keyed(skewed(spark), "k", 4, hot_rows=100)
    right = keyed(spark.range(400).select(F.col("id").alias("k"), F.col("id").alias("b")), "k", 4)
    text = plan(join_keyed(left, right), "simple")
    assert "__keyed_at" in text
    numbers = left.aside.select(F.pmod(F.xxhash64("__keyed_salt"), F.lit(4)).alias("p"))
    counts = [r["count"] for r in numbers.groupBy("p").count().collect()]
    assert len(counts) == 4 and max(counts) < 2 * min(counts)


def test_keyed_refuses_what_it_cannot_join(spark):
    frame = spark.createDataFrame([(1, 2)], "k long, a long")
    one = keyed(frame, "k", 2)
    with pytest.raises(ValueError, match="several sides"):
        join_keyed(one, one)
    with pytest.raises(ValueError, match="buckets"):
        join_keyed(one, keyed(frame.withColumnRenamed("a", "b"), "k", 3))
    with pytest.raises(ValueError, match="how"):
        join_keyed(one, how="full")


def test_empty_and_null_only_tables(spark):
    empty = keyed(spark.createDataFrame([], "k long, a long"), "k", 2)
    nulls = keyed(spark.createDataFrame([(None, 1)], "k long, b long"), "k", 2)
    assert join_keyed(empty, nulls).count() == 0
    assert [tuple(r) for r in join_keyed(nulls, empty, how="left").collect()] == [(None, 1, None)]
