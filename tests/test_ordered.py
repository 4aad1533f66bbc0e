import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.operators import ordered as o


def scored(spark, n=3000, seed=1):
    """A third of the rows share one score; the rest are spread."""
    rng = random.Random(seed)
    rows = [
        (i, 50.0 if i % 3 == 0 else float(rng.randrange(100)), rng.randrange(1, 9), "ab"[i % 2])
        for i in range(n)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k bigint, p double, w bigint, g string").repartition(5)


def brute_running(rows, by=lambda r: 0):
    out, sums = {}, {}
    for r in sorted(rows, key=lambda r: (by(r), r[1], r[0])):
        sums[by(r)] = sums.get(by(r), 0) + r[2]
        out[r[0]] = sums[by(r)]
    return out


@pytest.mark.parametrize("size", [10_000, 700, 100, 37])
def test_running_totals_equal_one_window(spark, size):
    rows, df = scored(spark)
    got = o.running_totals(df, ["p", "k"], {"c": F.col("w"), "n": F.lit(1)}, rows_per_range=size)
    got = got.collect()
    assert {r["k"]: r["c"] for r in got} == brute_running(rows)
    assert sorted(r["n"] for r in got) == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("size", [10_000, 100])
def test_running_totals_within_groups(spark, size):
    rows, df = scored(spark)
    rows += [(10_000 + i, 1.0 * i, 1, None) for i in range(50)]
    df = spark.createDataFrame(rows, "k bigint, p double, w bigint, g string")
    got = o.running_totals(df, ["p", "k"], {"c": F.col("w")}, by=["g"], rows_per_range=size).collect()
    assert {r["k"]: r["c"] for r in got} == brute_running(rows, by=lambda r: r[3] or "")


def test_ranges_split_a_hot_value(spark):
    rows, df = scored(spark)
    ranges = o.split_ranges(df, ["p", "k"], 100)
    sizes = [r["count"] for r in ranges.assign(df).groupBy("__range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 400
    assert sum(sizes) == len(rows)


def test_range_ids_follow_the_order(spark):
    _, df = scored(spark)
    placed = o.split_ranges(df, ["p", "k"], 200).assign(df).orderBy("p", "k").collect()
    ids = [r["__range"] for r in placed]
    assert ids == sorted(ids)


def test_ranges_over_other_types(spark):
    df = spark.range(500).select(
        F.col("id").cast("decimal(10,2)").alias("d"),
        F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, 0, id)").alias("t"),
    )
    for c in ("d", "t"):
        got = o.running_totals(df, [c], {"n": F.lit(1)}, rows_per_range=50).orderBy(c).collect()
        assert [r["n"] for r in got] == list(range(1, 501))


def brute_deciles(rows, bins, rule):
    running, total = brute_running(rows), sum(r[2] for r in rows)
    if rule is o.ceil_rule:
        return {k: max(1, min(bins, math.ceil(c / total * bins))) for k, c in running.items()}
    return {k: min(bins, math.floor(round(c / total * 100) / 100 * bins) + 1) for k, c in running.items()}


@pytest.mark.parametrize("rule", [o.ceil_rule, o.floor_rule])
@pytest.mark.parametrize("size", [10_000, 100])
def test_buckets_equal_one_window(spark, size, rule):
    rows, df = scored(spark)
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 10, rule, size)
    got = {r["k"]: r["b"] for r in df.select("k", bucket.alias("b")).collect()}
    assert got == brute_deciles(rows, 10, rule)


def test_bucket_goldens(spark):
    df = spark.createDataFrame([(i, float(i), 1) for i in range(10)], "k bigint, p double, w bigint")
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 10)
    assert [r[0] for r in df.orderBy("k").select(bucket).collect()] == list(range(1, 11))
    df = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 1), (3, 3.0, 1)], "k bigint, p double, w bigint")
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 2)
    assert [r[0] for r in df.orderBy("k").select(bucket).collect()] == [1, 1, 2]


def test_missing_weights_count_as_zero(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 1), (3, 3.0, 1)], "k bigint, p double, w bigint")
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 2)
    assert [r[0] for r in df.orderBy("k").select(bucket).collect()] == [1, 1, 2]


@pytest.mark.parametrize("weights", [[0, 0], [-1, 3], []])
def test_bad_weights_are_refused(spark, weights):
    rows = [(i, 1.0, w) for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "k bigint, p double, w bigint")
    with pytest.raises(ValueError):
        o.weighted_buckets(df, ["p", "k"], F.col("w"), 2)


@pytest.mark.parametrize("size", [10_000, 9])
def test_quantiles_are_exact(spark, size):
    rng = random.Random(5)
    xs = [round(rng.gauss(0, 10), 1) for _ in range(400)] + [3.0] * 200
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (math.nan,)], "x double")
    ps = [0.0, 0.05, 0.5, 0.951, 1.0]
    got = o.quantiles(df, "x", ps, size)
    assert got == pytest.approx(list(np.quantile(xs, ps)), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert math.isnan(o.quantiles(df, "x", [0.5])[0])


def test_fill_from_below(spark):
    grid = spark.createDataFrame([("f", n) for n in range(9)], "field string, ntile int")
    table = spark.createDataFrame([("f", 3, 0.1), ("f", 7, 0.4)], "field string, ntile int, shap double")
    got = o.fill_from_below(grid, table, ["field"], "ntile", "shap").orderBy("ntile").collect()
    assert [r["shap"] for r in got] == [0.1] * 7 + [0.4] * 2


def test_fill_forward_and_slice(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "b"), (3, None)], "pos int, x string")
    got = o.first_positions(o.fill_forward(df, ["x"], "pos"), "pos", 3).orderBy("pos").collect()
    assert [r["x"] for r in got] == ["a", "a", "b"]


def test_rows_are_never_gathered_in_one_task(spark):
    _, df = scored(spark)
    got = o.running_totals(df, ["p", "k"], {"c": F.col("w")}, rows_per_range=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in rows_side
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 10, rows_per_range=100)
    plan = df.groupBy(bucket.alias("b")).agg(F.sum("w"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("size", [10_000, 100])
def test_smallest_rows(spark, size):
    rows, df = scored(spark)
    got = [(r["p"], r["k"]) for r in o.smallest(df, ["p", "k"], 40, size).collect()]
    assert got == sorted((r[1], r[0]) for r in rows)[:40]
    assert o.smallest(df, ["p", "k"], 5000, size).count() == 3000


def test_few_large_ranges_are_as_right(spark, monkeypatch):
    monkeypatch.setattr(o, "MAX_RANGES", 3)
    rows, df = scored(spark)
    assert o.split_ranges(df, ["p", "k"], 10).count == 3
    got = o.running_totals(df, ["p", "k"], {"c": F.col("w")}, rows_per_range=10).collect()
    assert {r["k"]: r["c"] for r in got} == brute_running(rows)
    bucket = o.weighted_buckets(df, ["p", "k"], F.col("w"), 10, rows_per_range=10)
    assert {r["k"]: r["b"] for r in df.select("k", bucket.alias("b")).collect()} == brute_deciles(rows, 10, o.ceil_rule)


def test_bucket_sums_equal_buckets_row_by_row(spark):
    """Ties over a third of the rows, zero and missing weights, missing scores, fractional weights."""
    df = spark.range(6000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(997)) / 10.0).alias("p"),
        F.when(F.col("id") % 7 == 0, 0.0).when(F.col("id") % 11 == 0, None).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 8.0).alias("w"),
        (F.col("id") % 13).cast("decimal(12,2)").alias("f"),
    )
    df = df.withColumn("none", F.col("p").isNull().cast("int"))
    order = ["none", "p", "k"]
    score = F.when(F.col("none") == 1, float("inf")).otherwise(F.col("p"))
    for rule in (o.ceil_rule, o.floor_rule):
        bucket = o.weighted_buckets(df, order, F.col("w"), 10, rule)
        plain = df.groupBy(bucket.alias("bucket")).agg(F.sum("w").alias("w"), F.sum("f").alias("f"))
        for size in (o.summaries.SIZE, 40):
            small = o.condensed(df, order, score, F.col("w"), rule(10), size=size)
            assert small.count() < (6000 if size == 40 else 2600)
        for rows_per_range in (o.ROWS_PER_RANGE, 200):
            got = o.bucket_sums(df, order, score, F.col("w"), 10, ["w", "f"], rule, rows_per_range)
            assert got.schema["f"].dataType == plain.schema["f"].dataType
            a, b = (sorted(map(tuple, x.collect())) for x in (plain, got))
            assert [(r[0], round(r[1], 6), r[2]) for r in a] == [(r[0], round(r[1], 6), r[2]) for r in b]


def reads(spark, work):
    """How many jobs' stages read the table that ``work`` gets."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(20_000).select(
        F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7.0).alias("p"), F.lit(1.5).alias("w")
    )
    work(df.mapInArrow(count, df.schema))
    return seen.value / 20_000


def test_buckets_and_quantiles_read_their_input_twice(spark):
    def buckets(df):
        o.bucket_sums(df, ["p", "k"], F.col("p"), F.col("w"), 10, ["w"], rows_per_range=500).collect()

    assert reads(spark, buckets) == 2
    assert reads(spark, lambda df: o.quantiles(df, "p", [0.1, 0.5, 0.9], rows_per_range=500)) == 2
    # what is sorted is a small part of the rows
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7.0).alias("p"))
    assert o.condensed(df, ["p", "k"], F.col("p"), F.lit(1), o.ceil_rule(10)).count() < 2000
