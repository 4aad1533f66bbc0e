"""Weighted quantile summaries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.operators import summaries as sm


def rank(values, weights, x):
    """Weight below ``x``, and up to it."""
    return weights[values < x].sum(), weights[values <= x].sum()


def test_exact_and_merged_bounds_hold():
    rng = np.random.default_rng(1)
    for trial in range(40):
        values = rng.choice([rng.normal(size=300), rng.integers(0, 20, 300).astype(float)][trial % 2], 300)
        weights = rng.pareto(1.1, 300)
        parts = np.split(np.arange(300), sorted(rng.integers(0, 300, 5)))
        s = np.zeros((0, 4))
        for p in parts:
            s = sm.prune(sm.merge(s, sm.exact(values[p], weights[p])), 25)
        assert s[-1, 3] == pytest.approx(weights.sum())
        for x, below, own, upto in s:
            low, high = rank(values, weights, x)
            assert below <= low + 1e-9 and upto >= high - 1e-9 and own <= high - low + 1e-9
        # any rank is met within the slack the summary itself states
        for r in np.linspace(0, weights.sum(), 13):
            low, high = rank(values, weights, s[sm.nearest(s, np.array([r]))[0], 0])
            assert low - sm.slack(s) - 1e-9 <= r <= high + sm.slack(s) + 1e-9


def test_no_slack_without_pruning():
    s = sm.merge(sm.exact(np.array([1.0, 2, 2, np.nan]), np.ones(4)), sm.exact(np.array([0.0, 2, 5]), np.array([1.0, 3, 0])))
    assert s.tolist() == [[0, 0, 1, 1], [1, 1, 1, 2], [2, 2, 5, 7]]
    assert sm.slack(s) == 0 and sm.slack(np.zeros((0, 4))) == 0


def test_skewed_exposure_in_one_job(spark):
    """Rank errors on rows whose weights span six orders, of all columns at once."""
    n = 60_000
    df = spark.range(0, n, 1, 7).select(
        (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 1000.0).alias("a"),
        F.pow(10.0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)) / 10).alias("w"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, float("nan")).otherwise(F.col("id") % 9).cast("double").alias("b"),
        F.lit(None).cast("double").alias("c"),
    )
    before = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("summaries", "summaries")
    a, b, c = sm.summarise(df, ["a", "b", "c"], "w", size=512)
    jobs = before.getJobIdsForGroup("summaries")
    spark.sparkContext.setJobGroup(None, None)
    assert len(jobs) <= 2  # one query; adaptive execution submits its shuffle by itself
    data = df.toPandas()
    values, weights = data["a"].to_numpy(), data["w"].to_numpy()
    whole = weights.sum()
    assert sm.slack(a) < 0.02 * whole and len(a) <= 512
    for k in range(1, 64):
        low, high = rank(values, weights, a[sm.nearest(a, np.array([whole * k / 64]))[0], 0])
        assert low - sm.slack(a) <= whole * k / 64 <= high + sm.slack(a)
    assert b[:, 0].tolist() == list(range(9)) and sm.slack(b) < 1e-9 * whole
    assert len(c) == 0 and sm.cuts(c, 64).tolist() == []


def test_cuts():
    few = sm.exact(np.array([3.0, 1, 1, 2]), np.ones(4))
    assert sm.cuts(few, 4).tolist() == [1.5, 2.5]
    many = sm.exact(np.arange(1000.0), np.ones(1000))
    found = sm.cuts(many, 10)
    assert len(found) == 9 and np.allclose(found, np.arange(1, 10) * 100, atol=1.0)
    heavy = sm.exact(np.arange(1000.0), np.where(np.arange(1000) == 7, 1e9, 1.0))
    assert set(sm.cuts(heavy, 10)) == {7.0}
