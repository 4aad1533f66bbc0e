import itertools
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.operators import evaluate as ev
from liftworks.operators import model as md
from liftworks.operators import trees
from liftworks.sources import staging_root


@pytest.fixture(scope="module")
def rated(spark):
    df = spark.range(4000).select(
        F.col("id").alias("k"),
        (F.col("id") % 5).cast("double").alias("a"),
        ((F.col("id") * 7) % 13).cast("double").alias("b"),
        ((F.col("id") * 31) % 101 / 10).alias("c"),
        (1 + F.col("id") % 3).cast("double").alias("w"),
        (1 + F.floor(F.col("id") / 4) % 2).cast("double").alias("off"),
    )
    rate = F.exp(0.3 * F.col("a") - 0.1 * F.col("b")) * F.when(F.col("k") % 4 == 0, 4.0).otherwise(0.0)
    return df.withColumns({"y": rate, "yo": rate * F.col("off")}).cache()


FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def boosted(rated):
    return md.fit_boosted(
        rated, FEATURES, "y", "w", rounds=6, max_depth=3, learning_rate=0.3, stage_every=2, alpha=0.1
    )


def deviance(df, power=1.5):
    f = F.log("pred")
    loss = -F.col("y") * F.exp((1 - power) * f) / (1 - power) + F.exp((2 - power) * f) / (2 - power)
    return df.agg(F.sum(F.col("w") * loss)).first()[0]


def test_glm_recovers_factors(rated):
    model = md.fit_tweedie(rated, ["a", "b"], "y", "w")
    assert model.coefficients == pytest.approx((0.3, -0.1), abs=0.05)
    offset = md.fit_tweedie(rated, ["a", "b"], "yo", "w", offset="off")
    assert offset.coefficients == pytest.approx(model.coefficients, abs=0.05)
    a, b = (md.score(m, rated).orderBy("k").limit(6).collect() for m in (model, offset))
    assert [r["pred"] * r["off"] for r in a] == pytest.approx([r["pred"] for r in b], rel=0.1)


def test_linear_contributions_add_up(rated):
    model = md.fit_glm(rated, ["a", "b"], "y", "w")
    parts = model.contributions(rated, "k", "w").join(md.score(model, rated).select("k", "pred"), "k")
    gap = F.abs(F.col("a") + F.col("b") + F.col("base_value") - F.log("pred"))
    assert parts.agg(F.max(gap)).first()[0] < 1e-9


def test_boosting_lowers_the_loss(rated, boosted):
    losses = [
        deviance(md.score(md.BoostedModel(boosted.features, boosted.start, boosted.trees[:n]), rated))
        for n in range(0, 7, 2)
    ]
    assert losses == sorted(losses, reverse=True) and losses[0] > losses[-1]


def test_staged_margins_equal_the_scored_ones(rated, boosted):
    whole = md.fit_boosted(
        rated, FEATURES, "y", "w", rounds=6, max_depth=3, learning_rate=0.3, stage_every=100, alpha=0.1
    )
    a, b = (md.score(m, rated).orderBy("k").select("pred").toPandas()["pred"] for m in (boosted, whole))
    assert np.allclose(a, b)


def test_tree_contributions_add_up(rated, boosted):
    got = boosted.contributions(rated, "k", "w").join(md.score(boosted, rated).select("k", "pred"), "k")
    total = sum((F.col(c) for c in FEATURES), F.col("base_value"))
    assert got.agg(F.max(F.abs(total - F.log("pred")))).first()[0] < 1e-9
    assert got.count() == 4000


def test_min_child_weight_holds_exactly(rated):
    single = md.fit_boosted(rated, FEATURES, "y", "w", rounds=2, max_depth=3, min_child_weight=1e9)
    assert all(len(t.nodes) == 1 for t in single.trees)
    least = 150.0
    model = md.fit_boosted(rated, FEATURES, "y", "w", rounds=3, max_depth=4, min_child_weight=least)
    assert any(len(t.nodes) > 1 for t in model.trees)
    for tree in model.trees:
        assert all(n.cover >= least for n in tree.nodes)


def test_monotone_fit(spark, rated):
    falling = md.fit_boosted(rated, FEATURES, "y", "w", rounds=6, max_depth=3, monotone=[-1, 0, 0])
    grid = spark.range(5).select(
        F.col("id").cast("double").alias("a"), F.explode(F.array(F.lit(0.0), F.lit(7.0))).alias("b"), F.lit(5.0).alias("c")
    )
    rows = md.score(falling, grid).orderBy("b", "a").collect()
    for x, y in zip(rows, rows[1:]):
        assert x["b"] != y["b"] or y["pred"] <= x["pred"] * (1 + 1e-12)
    with pytest.raises(ValueError):
        md.fit_boosted(rated, FEATURES, "y", monotone=[1])


def test_a_fit_leaves_no_folder_behind(spark, rated):
    root = f"{staging_root(spark)}/liftworks"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    md.fit_boosted(rated, FEATURES, "y", "w", rounds=5, max_depth=2, stage_every=2)
    md.fit_glm(rated, ["a"], "y", "w")
    facts = ev.prediction_facts(rated.withColumn("pred", F.lit(1.0)).withColumn("num", F.col("y")), "num", "w")
    ev.lift(facts, "w", "k", rows_per_range=500).collect()
    assert set(os.listdir(root)) == before


def test_options(rated):
    model = md.fit_boosted(
        rated, FEATURES, "y", "w", offset="off", rounds=2, max_depth=2, subsample=0.5, colsample=0.67,
        min_child_weight=100, key="k",
    )
    for tree in model.trees:
        assert len({n.feature for n in tree.nodes if n.feature >= 0}) <= 2
    assert md.score(model, rated).filter("pred <= 0 or pred is null").count() == 0
    with pytest.raises(ValueError):
        md.fit_boosted(rated, FEATURES, "y", subsample=0.5)
    with pytest.raises(ValueError):
        md.fit_boosted(rated, FEATURES, "y", power=2.5)
    with pytest.raises(ValueError):
        md.fit_tweedie(rated, FEATURES, "y", method="other")
    with pytest.raises(ValueError):
        md.fit_boosted(rated.withColumn("y", F.lit(0.0)), FEATURES, "y")


def test_saved_models_score_the_same(spark, rated, boosted, tmp_path):
    for name, model in (("t", boosted), ("l", md.fit_glm(rated, ["a", "b"], "y", "w", offset="off"))):
        md.save_model(spark, model, f"{tmp_path}/{name}")
        assert md.load_model(spark, f"{tmp_path}/{name}") == model


def expected(tree, x, known, at=0):
    """Path-dependent expectation with the features of ``known`` fixed."""
    n = tree.nodes[at]
    if n.feature < 0:
        return n.value
    if n.feature in known:
        value = x[n.feature]
        left = n.missing_left if math.isnan(value) else value <= n.threshold
        return expected(tree, x, known, n.left if left else n.right)
    parts = [(tree.nodes[c].cover, expected(tree, x, known, c)) for c in (n.left, n.right)]
    return sum(w * v for w, v in parts) / n.cover


def shapley(tree, x):
    n = len(x)
    out = []
    for i in range(n):
        others, total = [j for j in range(n) if j != i], 0.0
        for size in range(n):
            for s in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                total += weight * (expected(tree, x, {*s, i}) - expected(tree, x, set(s)))
        out.append(total)
    return out


def test_contributions_are_shapley_values(boosted):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(0, 5, 20), rng.integers(0, 13, 20), rng.uniform(0, 10, 20)]).astype(float)
    for tree in boosted.trees[:3]:
        phi, base = trees.contributions(tree, x)
        assert base == pytest.approx(expected(tree, x[0], set()))
        for row, got in zip(x, phi):
            assert got == pytest.approx(shapley(tree, row), abs=1e-12)
        assert trees.predict(tree, x) == pytest.approx(phi.sum(axis=1) + base)


def test_sampled_contributions(rated, boosted):
    n = md.sample_contributions(boosted, rated, "k", 0.2).count()
    assert 600 < n < 1000


def test_monotone_check(rated):
    model = md.fit_glm(rated, ["a", "b"], "y", "w")
    facts = ev.prediction_facts(md.score(model, rated).withColumn("num", F.col("y") * F.col("w")), "num", "w")
    up = md.monotone_check(facts, "a", "w", 1).filter("violation").count()
    down = md.monotone_check(facts, "a", "w", -1).filter("violation").count()
    assert up == 0 and down == 4


def test_model_input(rated):
    assert md.model_input(rated, ["k", "w", "off", "y", "yo"]) == FEATURES


def test_missing_features_count_as_zero_in_linear_models(spark, rated):
    gaps = spark.createDataFrame([(1, None, math.nan, 2.0), (2, 0.0, 0.0, 2.0)], "k bigint, a double, b double, c double")
    model = md.fit_glm(rated, FEATURES, "y", "w")
    first, second = md.score(model, gaps).orderBy("k").collect()
    assert first["pred"] == second["pred"]
    first, second = model.contributions(gaps, "k").orderBy("k").collect()
    assert [first[c] for c in FEATURES] == [second[c] for c in FEATURES]
