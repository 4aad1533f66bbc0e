"""Boosting: missing values, histograms, resident rounds, resumption, deep contributions."""

import math
import os
import subprocess
import sys
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.operators import boosting, trees
from liftworks.operators import model as md

from test_model import expected, shapley

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def gaps(spark):
    """Rows whose missing values (null and NaN) have rates of their own."""
    k = F.col("id")
    df = spark.range(3000).select(
        k.alias("k"),
        F.when(k % 5 == 0, None).when(k % 5 == 1, float("nan")).otherwise((k % 7).cast("double")).alias("a"),
        F.when(k % 11 == 0, None).otherwise(((k * 7) % 13).cast("double")).alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("c"),
        (1 + k % 3).cast("double").alias("w"),
    )
    rate = F.exp(F.coalesce(F.nanvl("a", F.lit(6.0)), F.lit(6.0)) / 4 - F.coalesce(F.col("b"), F.lit(0.0)) / 10)
    return df.withColumn("y", rate * (1 + F.col("k") % 2)).cache()


def same(a: md.BoostedModel, b: md.BoostedModel) -> None:
    assert a.features == b.features and a.start == pytest.approx(b.start, rel=1e-12) and len(a.trees) == len(b.trees)
    for x, y in zip(a.trees, b.trees):
        assert [(n.feature, n.threshold, n.left, n.right, n.missing_left) for n in x.nodes] == [
            (n.feature, n.threshold, n.left, n.right, n.missing_left) for n in y.nodes
        ]
        assert [n.value for n in x.nodes] == pytest.approx([n.value for n in y.nodes], rel=1e-9, abs=1e-12)
        assert [n.cover for n in x.nodes] == pytest.approx([n.cover for n in y.nodes], rel=1e-9)


OPTIONS = {"rounds": 6, "max_depth": 3, "learning_rate": 0.3, "alpha": 0.1}


@pytest.mark.parametrize("more", [{}, {"subsample": 0.6, "colsample": 0.7, "key": "k"}, {"monotone": [1, -1, 0]}])
def test_resident_rounds_equal_rounds_by_jobs(gaps, more):
    resident = md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS, **more)
    same(resident, md.fit_boosted(gaps, FEATURES, "y", "w", tasks=0, stage_every=2, **OPTIONS, **more))
    same(resident, md.fit_boosted(gaps, FEATURES, "y", "w", tasks=3, keep_every=4, **OPTIONS, **more))


def test_jobs_do_not_grow_with_rounds(spark, gaps):
    counts = []
    for rounds in (2, 12):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "fit")
        md.fit_boosted(gaps, FEATURES, "y", "w", rounds=rounds, max_depth=3)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    spark.sparkContext.setJobGroup(None, None)
    assert counts[0] == counts[1] < 20


def test_rows_too_large_to_hold_go_by_jobs(gaps, monkeypatch):
    whole = md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS)
    monkeypatch.setattr(boosting, "RESIDENT_BYTES", 10)
    monkeypatch.setattr(boosting, "_resident", None)
    same(whole, md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS))


# --- missing values -------------------------------------------------------------------------------


def test_missing_rows_go_where_they_lower_the_loss(spark):
    """Three kinds of rows, of which the missing ones are like the small or like the large values."""
    for like, left in ((0.0, True), (9.0, False)):
        k = F.col("id")
        value = F.when(k % 3 == 0, 0.0).when(k % 3 == 1, 9.0)
        rate = F.when(F.coalesce(value, F.lit(like)) == 0.0, 1.0).otherwise(5.0)
        df = spark.range(900).select(k.alias("k"), value.alias("x"), rate.alias("y"))
        model = md.fit_boosted(df, ["x"], "y", rounds=1, max_depth=1)
        assert model.trees[0].nodes[0].missing_left is left
        for gap in (None, float("nan")):
            rows = spark.createDataFrame([(1, gap), (2, like)], "k long, x double")
            a, b = (r["pred"] for r in md.score(model, rows).orderBy("k").collect())
            assert a == b
            a, b = (r["x"] for r in model.contributions(rows, "k").orderBy("k").collect())
            assert a == b


def test_missing_alone_can_split(spark):
    k = F.col("id")
    df = spark.range(900).select(k.alias("k"), F.when(k % 3 != 0, (k % 3).cast("double")).alias("x"))
    df = df.withColumn("y", F.when(F.col("x").isNull(), 7.0).otherwise(1.0))
    root = md.fit_boosted(df, ["x"], "y", rounds=1, max_depth=1).trees[0].nodes[0]
    assert root.threshold == math.inf and not root.missing_left
    empty = df.withColumn("x", F.lit(None).cast("double"))
    assert len(md.fit_boosted(empty, ["x"], "y", rounds=1, max_depth=3).trees[0].nodes) == 1


def test_unseen_gaps_follow_the_heavier_side(spark):
    k = F.col("id")
    df = spark.range(1000).select(k.alias("k"), F.when(k % 10 == 0, 0.0).otherwise(1.0).alias("x"))
    df = df.withColumn("y", 1 + 3 * F.col("x"))
    assert not md.fit_boosted(df, ["x"], "y", rounds=1, max_depth=1).trees[0].nodes[0].missing_left


def test_saved_with_directions(spark, gaps, tmp_path):
    model = md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS)
    assert len({n.missing_left for t in model.trees for n in t.nodes if n.feature >= 0}) == 2
    md.save_model(spark, model, f"{tmp_path}/m")
    assert md.load_model(spark, f"{tmp_path}/m") == model


def test_scores_equal_margins_with_gaps(gaps):
    """The loss of the scored rows falls round by round, as the fit's own margins do."""
    model = md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS)
    losses = []
    for n in range(len(model.trees) + 1):
        f = F.log("pred")
        loss = F.col("w") * (2 * F.col("y") * F.exp(-0.5 * f) + 2 * F.exp(0.5 * f))
        part = md.BoostedModel(model.features, model.start, model.trees[:n])
        losses.append(md.score(part, gaps).agg(F.sum(loss)).first()[0])
    assert all(y < x for x, y in zip(losses, losses[1:]))


# --- histograms -----------------------------------------------------------------------------------


def plain_histograms(bins, slot, used, shape, g, h):
    out = np.zeros(shape)
    for r in range(bins.shape[1]):
        if slot[r] >= 0:
            for k, f in enumerate(used):
                out[slot[r], k, bins[f, r]] += (1, g[r], h[r])
    return out


def test_histograms_and_sibling_subtraction():
    rng = np.random.default_rng(7)
    n, width, bins = 700, 5, 8
    data = rng.integers(0, bins + 1, (width, n)).astype(np.uint8)
    g, h = rng.normal(size=n), rng.uniform(0.1, 1, n)
    cuts = [np.arange(bins - 1.0)] * width
    grower = trees.Grower(cuts, [0, 2, 3, 4], trees.Penalty(), bins)
    at = np.zeros(n, dtype=np.int64)
    for level in range(4):
        slot = grower.slots()[at]
        sums = trees.histograms(data, slot, grower.used, grower.shape, g, h)
        assert np.allclose(sums, plain_histograms(data, slot, grower.used, grower.shape, g, h))
        derived = dict(grower._above)
        opened = list(grower.open)
        grower.grow(sums)
        for node, (sibling, parent) in derived.items():
            whole = np.where(at == node, 0, -1)
            direct = trees.histograms(data, whole, grower.used, (1, *grower.shape[1:]), g, h)[0]
            other = trees.histograms(data, np.where(at == sibling, 0, -1), grower.used, (1, *grower.shape[1:]), g, h)[0]
            assert np.allclose(parent - other, direct) and direct[0, :, 0].sum() >= other[0, :, 0].sum()
            assert grower.sums[node] == pytest.approx((g[at == node].sum(), h[at == node].sum()))
        assert opened
        at = grower.step(data, at)
    assert (at == grower.place(data)).all()


def test_cost_is_linear_in_features():
    rng = np.random.default_rng(0)
    n, bins = 20_000, 64
    slot, g, h = rng.integers(0, 8, n), rng.normal(size=n), rng.uniform(size=n)
    took = {}
    for width in (40, 400):
        data = rng.integers(0, bins, (width, n)).astype(np.uint8)
        best = math.inf
        for _ in range(3):
            began = time.perf_counter()
            trees.histograms(data, slot, range(width), (8, width, bins + 1, 3), g, h)
            best = min(best, time.perf_counter() - began)
        took[width] = best
    assert took[400] < 20 * took[40]


def test_wide_fit(spark):
    """Four hundred features, most of them noise."""
    cols = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("double").alias(f"x{k}") for k in range(400)]
    df = spark.range(2000).select("id", *cols).withColumn("y", F.exp(F.col("x17") / 10))
    model = md.fit_boosted(df, [f"x{k}" for k in range(400)], "y", rounds=2, max_depth=2)
    assert all(t.nodes[0].feature == 17 for t in model.trees)


# --- resumption -----------------------------------------------------------------------------------


def test_an_interrupted_fit_goes_on(spark, gaps, tmp_path, monkeypatch):
    whole = md.fit_boosted(gaps, FEATURES, "y", "w", **OPTIONS)
    work, calls = boosting._resident, []

    def breaking(current, settings, fitted, count, tasks):
        calls.append(len(fitted))
        if len(fitted) == 4:
            raise RuntimeError("lost")
        return work(current, settings, fitted, count, tasks)

    monkeypatch.setattr(boosting, "_resident", breaking)
    with pytest.raises(RuntimeError):
        md.fit_boosted(gaps, FEATURES, "y", "w", keep_every=2, resume=str(tmp_path), **OPTIONS)
    monkeypatch.setattr(boosting, "_resident", work)
    seen = []
    monkeypatch.setattr(boosting, "_resident", lambda *a: seen.append(len(a[2])) or work(*a))
    same(whole, md.fit_boosted(gaps, FEATURES, "y", "w", keep_every=2, resume=str(tmp_path), **OPTIONS))
    assert calls == [0, 2, 4] and seen == [4]
    # other settings start anew
    other = OPTIONS | {"alpha": 0.2}
    seen.clear()
    md.fit_boosted(gaps, FEATURES, "y", "w", keep_every=2, resume=str(tmp_path), **other)
    assert seen == [0, 2, 4]


KILLED = f"""
import os, sys
sys.path.insert(0, {REPO!r})
from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from liftworks.operators import boosting, model as md
df = spark.range(400).select((F.col("id") % 5).cast("double").alias("a"), (1.0 + F.col("id") % 5).alias("y"))
whole = md.fit_boosted(df, ["a"], "y", rounds=5, max_depth=2, tasks=2)
add, mark = boosting.gathered, sys.argv[1] + "/killed"
def killing(context, sums):
    killing.turns = getattr(killing, "turns", 0) + 1
    if killing.turns == 6 and context.partitionId() == 1 and not os.path.exists(mark):
        open(mark, "w").close()
        os._exit(1)
    return add(context, sums)
boosting.gathered = killing
again = md.fit_boosted(df, ["a"], "y", rounds=5, max_depth=2, tasks=2)
assert os.path.exists(mark)
assert [t.nodes[0].threshold for t in again.trees] == [t.nodes[0].threshold for t in whole.trees]
assert all(abs(x.value - y.value) < 1e-9 for t, u in zip(again.trees, whole.trees) for x, y in zip(t.nodes, u.nodes))
print("equal")
spark.stop()
"""


def test_a_stage_that_loses_a_task_is_run_again(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", KILLED, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, timeout=400
    )
    assert done.returncode == 0 and done.stdout.strip().endswith("equal"), done.stderr[-3000:]


# --- contributions --------------------------------------------------------------------------------


def grown_tree(rng, depth, width):
    """A full tree of random splits, with covers that add up."""
    nodes = []

    def grow(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == depth or rng.random() < 0.1:
            nodes[at] = trees.Node(-1, 0.0, -1, -1, float(rng.normal()), cover)
            return at
        part = float(rng.uniform(0.05, 0.95))
        feature, threshold, missing = int(rng.integers(width)), float(rng.uniform()), bool(rng.random() < 0.5)
        left, right = grow(level + 1, cover * part), grow(level + 1, cover * (1 - part))
        nodes[at] = trees.Node(feature, threshold, left, right, 0.0, cover, missing)
        return at

    grow(0, 100.0)
    return trees.Tree(tuple(nodes))


@pytest.mark.parametrize("tabled", [0, 3, 6])
def test_contributions_equal_brute_force_to_depth_six(monkeypatch, tabled):
    monkeypatch.setattr(trees, "TABLED", tabled)
    rng = np.random.default_rng(tabled)
    for depth in range(0, 7):
        tree = grown_tree(rng, depth, 6)
        x = rng.uniform(size=(6, 6))
        x[rng.random(x.shape) < 0.25] = np.nan
        phi, base = trees.contributions(tree, x)
        assert base == pytest.approx(expected(tree, x[0], set()))
        for row, got in zip(x, phi):
            assert got == pytest.approx(shapley(tree, row), abs=1e-10)
        assert trees.predict(tree, x) == pytest.approx(phi.sum(axis=1) + base)


def test_a_path_of_twenty_features():
    """Deep paths need no table: contributions add up, and equal trees over fewer features agree."""
    rng = np.random.default_rng(3)
    nodes, cover = [], 1000.0
    for level in range(20):
        nodes.append(trees.Node(level, 0.5, 2 * level + 2, 2 * level + 1, 0.0, cover, level % 3 == 0))
        cover *= 0.8
        nodes.append(trees.Node(-1, 0.0, -1, -1, float(rng.normal()), cover / 4))
    nodes.append(trees.Node(-1, 0.0, -1, -1, 5.0, cover))
    # order by index: inner nodes at 0, 2, 4, ...; their right leaves at 1, 3, ...
    tree = trees.Tree(tuple(nodes))
    assert max(len(leaf.used) for leaf in trees.leaves(tree)) == 20
    x = rng.uniform(0, 0.7, size=(500, 20))
    x[rng.random(x.shape) < 0.05] = np.nan
    phi, base = trees.contributions(tree, x)
    assert np.allclose(trees.predict(tree, x), phi.sum(axis=1) + base, atol=1e-9)
    deepest = [leaf for leaf in trees.leaves(tree) if len(leaf.used) == 20][0]
    passes = np.ones((1, 20), dtype=bool)
    by_size = trees.leaf_values(deepest.value, deepest.share, passes)
    assert by_size.sum() == pytest.approx(deepest.value - deepest.expected)


def test_shares_of_nothing():
    """A branch that no training row reached has share 0: no division by it."""
    tree = trees.Tree((
        trees.Node(0, 0.5, 1, 2, 0.0, 10.0), trees.Node(-1, 0, -1, -1, 3.0, 10.0), trees.Node(1, 0.5, 3, 4, 0.0, 0.0),
        trees.Node(-1, 0, -1, -1, 1.0, 0.0), trees.Node(-1, 0, -1, -1, 2.0, 0.0),
    ))
    phi, base = trees.contributions(tree, np.array([[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]))
    assert np.isfinite(phi).all() and base == pytest.approx(3.0)
