import pytest
from pyspark.sql import functions as F

from liftworks.operators import evaluate as ev


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(i, float(i % 7), i % 5 + 1, float(i % 11), float(i % 7) * (i % 5 + 1)) for i in range(500)]
    df = spark.createDataFrame(
        rows, "k bigint, pred double, weight bigint, incurred_act double, incurred_pred double"
    )
    return df.withColumns({"denom": F.col("weight"), "ep": F.col("k") % 4}).cache()


def test_gini_golden(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (8,)], "a bigint").withColumn("p", F.col("a"))
    assert ev.gini(df, "a", "p", ["p"]).first()["gini"] == pytest.approx(0.4)


def test_gini_by_definition(spark, facts):
    rows = sorted(facts.collect(), key=lambda r: (r["pred"], r["k"]))
    total, c, curve = sum(r["incurred_act"] for r in rows), 0.0, []
    for r in rows:
        c += r["incurred_act"]
        curve.append(c / total)
    n = len(rows)
    want = 1 - 2 * sum((curve[i] + curve[i - 1]) / 2 / n for i in range(1, n))
    for size in (10_000, 60):
        got = ev.gini(facts, "incurred_act", "pred", ["k"], size).first()
        assert got["n"] == n and got["gini"] == pytest.approx(want, abs=1e-12)


def test_lorenz_starts_at_origin_and_ends_at_one(facts):
    points = ev.lorenz(facts, "incurred_act", "pred", ["k"], 60).orderBy("position").collect()
    assert tuple(points[0]) == (0, 0.0, 0.0)
    assert points[-1]["population_share"] == 1.0 and points[-1]["actual_share"] == pytest.approx(1.0)
    shares = [p["actual_share"] for p in points]
    assert shares == sorted(shares) and len(points) == facts.count() + 1


@pytest.mark.parametrize("variant", ["fast", "relativity", "legacy_pct"])
@pytest.mark.parametrize("size", [10_000, 60])
def test_lift_keeps_totals_and_order(facts, variant, size):
    table = ev.lift(facts, "weight", "k", variant=variant, rows_per_range=size).orderBy("decile").collect()
    assert sum(r["weight"] for r in table) == facts.agg(F.sum("weight")).first()[0]
    levels = [r["pred"] for r in table]
    assert levels == sorted(levels)
    assert sum(r["weight_pct"] for r in table) == pytest.approx(100.0)


def test_relativity_bases(facts):
    fast = ev.lift(facts, "weight", "k").orderBy("decile").first()
    pred = ev.lift(facts, "weight", "k", variant="relativity").orderBy("decile").first()
    act = ev.lift(facts, "weight", "k", variant="relativity", base="act").orderBy("decile").first()
    overall = ev.overall_levels(facts).first()
    assert fast["act_rel"] == pytest.approx(fast["act"] / overall["overall_pred"])
    assert pred["act_rel"] == pytest.approx(fast["act"] / overall["overall_act"])
    assert pred["pred_rel"] == pytest.approx(fast["pred"] / overall["overall_pred"])
    assert act["pred_rel"] == pytest.approx(fast["pred"] / overall["overall_act"])


def test_premium_lift_drops_rows_without_premium(facts):
    table = ev.lift(facts, "weight", "k", variant="premium", premium="ep")
    kept = facts.filter("ep > 0")
    assert table.agg(F.sum("ep")).first()[0] == kept.agg(F.sum("ep")).first()[0]
    lost = ev.excluded_loss_share(facts, "ep").first()
    assert lost["dropped_rows"] == facts.filter("ep <= 0").count()
    share = facts.filter("ep <= 0").agg(F.sum("incurred_act")).first()[0] / facts.agg(F.sum("incurred_act")).first()[0]
    assert lost["actual_share"] == pytest.approx(share)


def test_preconditions(facts):
    with pytest.raises(ValueError, match="is absent"):
        ev.lift(facts.drop("pred"), "weight", "k", variant="relativity")
    with pytest.raises(ValueError, match="two buckets"):
        ev.lift(facts, "weight", "k", bins=1, variant="relativity")
    with pytest.raises(ValueError, match="denom is not positive"):
        ev.lift(facts.withColumn("denom", F.lit(0)), "weight", "k", variant="relativity")
    with pytest.raises(ValueError, match="negative"):
        ev.lift(facts.withColumn("weight", F.lit(-1)), "weight", "k", variant="relativity")
    with pytest.raises(ValueError, match="adds up to nothing"):
        ev.lift(facts.withColumn("weight", F.lit(0)), "weight", "k", variant="relativity")
    with pytest.raises(ValueError, match="relativities"):
        ev.lift(facts, "weight", "k", variant="relativity", base="both")
    with pytest.raises(ValueError, match="variant"):
        ev.lift(facts, "weight", "k", variant="other")
    with pytest.raises(ValueError, match="premium"):
        ev.lift(facts, "weight", "k", variant="premium")


def test_residual_levels_round_but_do_not_merge(spark):
    df = spark.createDataFrame(
        [(0.101, 1, 1.0, 2.0, 1), (0.104, 1, 3.0, 2.0, 1), (None, 1, 9.0, 9.0, 1)],
        "x double, w int, incurred_act double, incurred_pred double, denom int",
    )
    rows = ev.residual_table(df, "x", "w").collect()
    assert sorted((r["lo"], r["act"]) for r in rows) == [(0.1, 1.0), (0.1, 3.0)]


@pytest.mark.parametrize("size", [10_000, 20])
def test_residual_bins_match_pandas(spark, size):
    import pandas as pd

    rows = [(i * 0.37, 1, float(i), float(i % 5), 2) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, w int, incurred_act double, incurred_pred double, denom int")
    got = ev.residual_table(df, "x", "w", rows_per_range=size).orderBy("lo").collect()
    pdf = df.toPandas()
    pdf["x"] = pdf["x"].round(2)
    want = pdf.groupby(pd.qcut(pdf["x"], 20, duplicates="drop"), observed=True)[["incurred_act"]].sum()
    assert [r["incurred_act"] for r in got] == list(want["incurred_act"])


def test_residual_tables_read_all_features_at_once(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("few"), (F.col("id") * 1.5).alias("many"), F.lit(1).alias("w"), F.lit(1).alias("denom"),
        F.col("id").alias("incurred_act"), F.lit(2).alias("incurred_pred"),
    )
    rows = ev.residual_tables(df, ["few", "many"], "w").groupBy("field").agg(F.count("*").alias("n"), F.sum("w").alias("w"))
    assert {r["field"]: (r["n"], r["w"]) for r in rows.collect()} == {"few": (3, 300), "many": (20, 300)}


def test_weight_column_fallback():
    assert ev.weight_column(["a", "ee"], "a") == "a"
    assert ev.weight_column(["ee", "ee_imps"], "gone") == "ee"
    assert ev.weight_column(["ee_imps"], None) == "ee_imps"
    assert ev.weight_column(["x"], "gone") is None
    with pytest.raises(ValueError):
        ev.weight_column(["ee"], "gone", strict=True)


def test_score_facts_without_exposure(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "pp double, pred double")
    row = ev.score_facts(df, "pp", None).first()
    assert (row["incurred_act"], row["incurred_pred"], row["denom"], row["weight"]) == (1.0, 2.0, 1, 1)


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (5.0, 2.0, "a")], "y double, p double, s string")
    row = ev.error_metrics(df, "y", "p", "s").first()
    assert row["mae"] == 2.0 and row["rmse"] == pytest.approx(5.0**0.5) and row["size"] == 2
