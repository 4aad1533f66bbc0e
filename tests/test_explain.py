import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from liftworks.operators import explain as ex


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(i, 0.1 * (i % 3 - 1), 0.0, 0.002 * (i % 50), 1 + i % 4) for i in range(600)]
    contrib = spark.createDataFrame(rows, "k bigint, a double, b double, c double, weight bigint")
    data = contrib.select("k", (F.col("k") % 3).alias("a"), F.lit(True).cast("int").alias("b"), (F.col("k") % 7).cast("double").alias("c"))
    return contrib.cache(), data.cache()


def values_of(spark, rows):
    return spark.createDataFrame(rows, "field string, val double, shap double, weight bigint")


def test_aggregate(frames):
    contrib, _ = frames
    rows = ex.contrib_aggregate(contrib, ["a", "b", "c"], "weight").collect()
    assert {r["field"] for r in rows} == {"a", "c"}  # never used fields drop out
    assert rows[-1]["cum_shap_abs_pct"] == pytest.approx(1.0)
    assert sum(r["shap_abs_pct"] for r in rows) == pytest.approx(1.0)
    assert ex.contrib_totals(contrib, ["a", "b", "c"], "weight").count() == 3


def test_remainder_row_golden(spark):
    table = spark.createDataFrame([("x", 50.0), ("y", 30.0), ("z", 20.0)], "field string, pct double")
    rows = [(r["feature"], r["pct"]) for r in ex.with_remainder(table, "pct", 2).collect()]
    assert rows == [("x", 50.0), ("y", 30.0), ("Sum of 1 other features", 20.0)]
    assert ex.with_remainder(table, "pct", 3).count() == 3
    zero = spark.createDataFrame([("x", 50.0), ("y", 0.0)], "field string, pct double")
    assert ex.with_remainder(zero, "pct", 1).count() == 1
    assert [r["field"] for r in ex.top_features(table, "pct", 2).collect()] == ["x", "y"]


def percentile(levels, p, digits=5):
    """One level list [(contribution, weight)] by the stated rule."""
    levels = sorted((s, w) for s, w in levels if s != 0)
    total, run, diffs = sum(w for _, w in levels), 0, []
    for s, w in levels:
        run += w
        diffs.append((run / total - p / 100, s))
    kept = []
    for sign in (-1, 0, 1):
        same = [d for d in diffs if (d[0] > 0) - (d[0] < 0) == sign]
        if same:
            least = min(abs(d[0]) for d in same)
            kept += [d for d in same if abs(d[0]) == least]
    lo, hi = min(s for _, s in kept), max(s for _, s in kept)
    dmin, dmax = min(d for d, _ in kept), max(d for d, _ in kept)
    if dmax == dmin:
        return hi if dmax > 0 else None
    mixed = -dmin / (dmax - dmin) * lo + dmax / (dmax - dmin) * hi
    return round(mixed * 10**digits) / 10**digits


def test_percentile_goldens(spark):
    rows = [("f", 0.0, s, 1) for s in (1.0, 2.0, 3.0)] + [("f", 1.0, 5.0, 2), ("f", 2.0, 0.0, 9)]
    got = {r["val"]: r for r in ex.contrib_percentiles(values_of(spark, rows)).collect()}
    first = got[0.0]
    assert (first["shap_p0"], first["shap_p5"], first["shap_p95"], first["shap_p100"]) == (1.0, 1.0, 2.15, 2.0)
    assert (got[1.0]["shap_p0"], got[1.0]["shap_p95"], got[1.0]["shap_p100"]) == (5.0, 5.0, None)
    assert 2.0 not in got


def test_percentiles_by_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [
        (f, float(v), rng.randrange(-30, 30) / 100, rng.randrange(0, 5))
        for f in "fg" for v in range(6) for _ in range(v * 4 + 1)
    ]
    groups = defaultdict(lambda: defaultdict(int))
    for f, v, s, w in rows:
        groups[f, v][s] += w
    levels = [(f, v, s, w) for (f, v), g in groups.items() for s, w in g.items()]
    used = {k: g for k, g in groups.items() if sum(w for s, w in g.items() if s != 0)}
    levels = [r for r in levels if (r[0], r[1]) in used]
    for r in ex.contrib_percentiles(values_of(spark, levels)).collect():
        for p in (0, 5, 95, 100):
            want = percentile(list(used[r["field"], r["val"]].items()), p)
            got = r[f"shap_p{p}"]
            assert got == want or got == pytest.approx(want, abs=2e-5), (r, p)


def test_summary(spark):
    rows = [("f", 0.0, 1.0, 2), ("f", 0.0, 0.0, 2), ("f", 1.0, 3.0, 4), ("g", 0.0, 0.0, 5), ("h", 0.0, -9.0, 1)]
    values = values_of(spark, rows)
    got = {(r["field"], r["val"]): r for r in ex.contrib_summary(values).collect()}
    assert set(got) == {("f", 0.0), ("f", 1.0), ("h", 0.0)}
    assert (got["f", 0.0]["pct_weight"], got["f", 0.0]["pct_used"], got["f", 0.0]["shap_mean"]) == (0.5, 0.5, 1.0)
    mono = spark.createDataFrame([("f", 1)], "field string, mono int")
    out = spark.createDataFrame([("h",)], "field string")
    table = ex.contrib_summary_all(values, mono, out).collect()
    assert [(r["field"], r["val"], r["mono"]) for r in table] == [("f", 1.0, 1), ("f", 0.0, 1)]
    assert table[0]["field_tot_wtd_shap_abs"] == pytest.approx(0.5 * 0.5 * 1.0 + 0.5 * 3.0)


def test_range_truncates_percentiles(spark):
    long = spark.createDataFrame(
        [("f", 0.4, 0.1, 29), ("f", 0.0, 0.2, 71), ("f", None, 0.3, 5), ("f", 0.0, None, 5), ("g", 9.0, 0.0, 1)],
        "field string, val double, contrib double, weight bigint",
    )
    got = {(r["field"], r["ntile"]): r["shap"] for r in ex.contrib_range(long).collect()}
    assert got == {("f", 28): 0.1, ("f", 100): 0.2, ("g", 100): 0.0}
    used = ex.contrib_range(long, only_used=True)
    assert used.filter("field = 'g'").count() == 0
    filled = ex.fill_range(ex.contrib_range(long.filter("field = 'f'"))).orderBy("ntile").collect()
    assert len(filled) == 101 and [filled[i]["shap"] for i in (0, 27, 28, 99, 100)] == [0.1, 0.1, 0.1, 0.1, 0.2]
    assert ex.fill_range(ex.contrib_range(long), (10, 20)).count() == 22


def test_weight_distribution(frames):
    contrib, data = frames
    long = ex.long_contributions(contrib, data, ["a", "b"], "k", "weight")
    rows = {(r["field"], r["val"]): r for r in ex.contrib_weight_dist(long).collect()}
    assert rows["b", 1.0]["used_weight"] is None and rows["a", 1.0]["used_weight"] is None
    assert rows["a", 0.0]["used_weight"] == rows["a", 0.0]["weight"]


def test_contributions_are_joined_by_key(frames):
    contrib, data = frames
    long = ex.long_contributions(contrib.orderBy(F.desc("k")), data, ["a"], "k", "weight")
    for r in ex.contrib_value_table(long).collect():
        assert r["shap"] == pytest.approx(0.1 * (r["val"] - 1))


@pytest.mark.parametrize("size", [10_000, 50])
def test_feature_bounds(spark, size):
    rows = [("f", float(i), 0.0, 1) for i in range(1000)] + [("g", 5.0, 0.0, 98), ("g", 6.0, 0.0, 2)]
    long = spark.createDataFrame(rows, "field string, val double, contrib double, weight bigint")
    got = {r["field"]: (r["low"], r["high"]) for r in ex.feature_bounds(long, rows_per_range=size).collect()}
    assert got == {"f": (9.0, 989.0), "g": (5.0, 6.0)}


def test_importance_of_missing_contributions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (math.nan, 2.0), (None, -4.0)], "a double, b double")
    got = {r["field"]: r["importance"] for r in ex.importance(df, ["a", "b"]).collect()}
    assert got["a"] == 1.0 and got["b"] == pytest.approx(8 / 3)
