"""Queries over whole runs: the staged job, the older end-to-end flow, comparisons."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from liftworks.operators import assemble as asm
from liftworks.operators import condition as con
from liftworks.operators import evaluate as ev
from liftworks.operators import model as md
from liftworks.plans import bindings as b
from liftworks.plans import stages
from liftworks.plans.config import Config
from liftworks.plans.registry.core import FEATURES_SQL, POLICY_SQL, PREMIUM_SQL, query, r6, tidy, with_views
from liftworks.plans.registry.modelling import _RATED_SQL, _stump_rounds_sql
from liftworks.sources import fresh_dir, stage


def _experiment(spark, sf_dir, **changes):
    """Order-grain tables for the staged job, and a configuration that points to them."""
    root = fresh_dir(spark, "experiment")
    feats = b.features(spark, sf_dir).withColumnRenamed("o_orderkey", "vin_date").drop("fold")
    feats.write.parquet(f"{root}/master")
    b.policy(spark, sf_dir).select(
        F.col("o_orderkey").alias("VIN_Date"), "fold",
        (F.col("incurred_act") / F.col("exposure")).cast("double").alias("pp"),
        F.col("exposure").alias("ee"),
    ).write.parquet(f"{root}/aux")
    settings = {
        "name": "orders", "target": "pp", "master": f"{root}/master", "aux": f"{root}/aux",
        "output": f"{root}/output", "debug_level": 0,
        "columns_to_load": ["lvl_a", "lvl_b", "flag", "cont"],
        "features": ["lvl_a", "lvl_b", "flag", "cont", "vc_absent"],
        "model": {"method": "boost", "rounds": 2, "max_depth": 2},
    }
    return Config(**(settings | changes))


@query(
    "staged_run_log",
    with_views(POLICY_SQL)
    + """,
n AS (SELECT count(*) AS a, count(*) FILTER (fold = 6) AS t FROM policy)
SELECT 'orders' AS experiment, s.stage, 'success' AS status,
       CASE s.stage WHEN 'stage_03' THEN 6 + (SELECT count(DISTINCT fold) FROM policy) WHEN 'stage_07' THEN 4
                    WHEN 'stage_05' THEN t ELSE a END AS rows
FROM n, (VALUES ('stage_01'), ('stage_02'), ('stage_03'), ('stage_04'), ('stage_05'), ('stage_06'),
                ('stage_07')) AS s(stage)""",
)
def staged_run_log(spark, sf_dir):
    """The whole job over the shared tables: the row count of every stage."""
    log = stages.run_stages(spark, _experiment(spark, sf_dir))
    return log.select("experiment", "stage", "status", "rows")


@query(
    "staged_rerun_log",
    with_views(POLICY_SQL)
    + """,
n AS (SELECT count(*) AS a, count(*) FILTER (fold = 6) AS t FROM policy)
SELECT r.run, s.stage,
       CASE WHEN r.run = 'same' OR r.run = 'model' AND s.stage < 'stage_05' THEN 'reused'
            WHEN r.run = 'table' AND s.stage = 'stage_05' THEN 'stale' ELSE 'success' END AS status,
       CASE WHEN r.run = 'table' AND s.stage = 'stage_05' THEN -1
            WHEN s.stage = 'stage_03' THEN 6 + (SELECT count(DISTINCT fold) FROM policy)
            WHEN s.stage = 'stage_05' THEN t ELSE a END AS rows
FROM n, (VALUES ('first'), ('same'), ('model'), ('table')) AS r(run),
  (VALUES ('stage_01'), ('stage_02'), ('stage_03'), ('stage_04'), ('stage_05')) AS s(stage)""",
)
def staged_rerun_log(spark, sf_dir):
    """Four runs of one experiment up to its fit: the first, one with nothing changed, one with another
    model, and one after the input table was written anew, with the fit switched off."""
    off = {"stage_06": False, "stage_07": False}
    cfg = _experiment(spark, sf_dir, stages=off)
    out = None
    for run in ("first", "same", "model", "table"):
        if run == "model":
            cfg = replace(cfg, model=cfg.model | {"rounds": 1})
        if run == "table":
            cfg = replace(cfg, stages=off | {"stage_05": False})
            spark.read.parquet(cfg.aux).write.parquet(f"{cfg.aux}_copy")
            spark.read.parquet(f"{cfg.aux}_copy").write.mode("overwrite").parquet(cfg.aux)
        log = stages.run_stages(spark, cfg, reuse=True).filter("stage <= 'stage_05'").select(
            F.lit(run).alias("run"), "stage", "status", F.coalesce("rows", F.lit(-1)).alias("rows")
        )
        out = log if out is None else out.unionByName(log)
    return out


@query(
    "experiments_log",
    with_views(POLICY_SQL)
    + """,
n AS (SELECT count(*) AS a FROM policy)
SELECT e.name AS experiment, s.stage, 'success' AS status, a AS rows
FROM n, (VALUES ('first'), ('second'), ('third')) AS e(name), (VALUES ('stage_01'), ('stage_02')) AS s(stage)
UNION ALL SELECT 'lost', 'stage_01', 'failed', -1""",
)
def experiments_log(spark, sf_dir):
    """Four experiments side by side, one of which has no input."""
    cfg = _experiment(spark, sf_dir, stages={f"stage_0{k}": False for k in range(3, 8)})
    runs = [replace(cfg, name=n, output=f"{cfg.output}_{n}") for n in ("first", "second", "third")]
    runs.insert(1, replace(cfg, name="lost", output=f"{cfg.output}_lost", aux=f"{cfg.aux}_nowhere"))
    log = stages.run_all(spark, runs, at_once=3).filter("status != 'skipped'")
    return log.select("experiment", "stage", "status", F.coalesce("rows", F.lit(-1)).alias("rows"))


def _errors(alias: str, pred: str) -> str:
    return f"""
{alias} AS (
  SELECT avg(abs(e)) FILTER (train) AS train_mae, avg(abs(e)) FILTER (NOT train) AS test_mae,
         sqrt(avg(e * e) FILTER (train)) AS train_rmse, sqrt(avg(e * e) FILTER (NOT train)) AS test_rmse
  FROM (SELECT train, {pred} - CAST(incurred_act AS DOUBLE) AS e FROM policy))"""


@query(
    "experiment_compare",
    with_views(POLICY_SQL, _errors("a", "pred"), _errors("z", "CAST(cont AS DOUBLE) / 20.0"))
    + " UNION ALL ".join(
        f"""
SELECT '{m}' AS metric, round_even(a.{m} * 1000.0, 0) / 1000.0 AS first,
       round_even(z.{m} * 1000.0, 0) / 1000.0 AS second,
       round_even((z.{m} - a.{m}) * 1000.0, 0) / 1000.0 AS difference FROM a, z"""
        for m in ("train_mae", "test_mae", "train_rmse", "test_rmse")
    ),
)
def experiment_compare(spark, sf_dir):
    """Errors of the banded score against those of the unbanded one."""
    df = b.policy(spark, sf_dir).withColumn("smooth", F.col("cont") / 20.0)
    tables = [
        stages.metrics_long(ev.run_metrics(df, "incurred_act", p, F.col("train"), 1))
        for p in ("pred", "smooth")
    ]
    errors = stages.compare_metrics(*tables).filter(~F.col("metric").isin("train_size", "test_size", "n_features"))
    return tidy(errors, 3)


@query(
    "legacy_flow",
    with_views(
        FEATURES_SQL, POLICY_SQL, PREMIUM_SQL,
        _RATED_SQL.replace("FROM features f", "FROM (SELECT * FROM features WHERE fold <= 5) f"),
        _stump_rounds_sql(1),
        """
scored AS (
  SELECT p.o_orderkey, p.exposure, p.incurred_act, exp(m.f) AS pred, p.exposure * exp(m.f) AS incurred_pred, ep
  FROM policy p JOIN features f USING (o_orderkey)
  JOIN (SELECT DISTINCT flag, f FROM m1) m ON m.flag = f.flag
  JOIN premium USING (o_orderkey)
  WHERE p.train AND ep > 0 AND incurred_act >= 0),
run AS (
  SELECT *, greatest(1, least(10, CAST(ceil(
         CAST(sum(exposure) OVER (ORDER BY pred, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE)
         / CAST(sum(exposure) OVER () AS DOUBLE) * 10) AS INTEGER))) AS decile
  FROM scored),
d AS (
  SELECT decile, CAST(sum(exposure) AS BIGINT) AS exposure, CAST(sum(incurred_act) AS DOUBLE) AS ia,
         sum(incurred_pred) AS ip, CAST(sum(ep) AS DOUBLE) AS dn FROM run GROUP BY decile)""",
    )
    + f"""
SELECT decile, exposure, {r6('ia / dn')} AS act, {r6('ip / dn')} AS pred,
       {r6('ia / dn / (sum(ia) OVER () / sum(dn) OVER ())')} AS act_rel,
       {r6('ip / dn / (sum(ip) OVER () / sum(dn) OVER ())')} AS pred_rel
FROM d""",
)
def legacy_flow(spark, sf_dir):
    """Derive, blank, clip and round; fit on training rows; lift over earned premium of those rows."""
    feats = b.features(spark, sf_dir).drop("fold", "o_orderstatus")
    facts = b.policy(spark, sf_dir).select(
        "o_orderkey", "train", "exposure", "incurred_act", "offset_f",
        F.lit("1.1").cast("decimal(2,1)").alias("type_factor"),
    )
    data = con.derive_offset(
        facts.join(feats, "o_orderkey"), ["offset_f", "type_factor"], "incurred_act", "offset_all"
    )
    data = con.constant_columns(data, ["vc_suv", "vc_truck"])
    data = con.drop_if_present(data, ["type_factor", "offset_f", "vc_absent"])
    data = con.keep_selected(
        data, ["train", "o_orderkey", "exposure", "incurred_act", "offset_all"], ["flag", "lvl_a", "cont", "c_mktsegment"]
    )
    data = stage(data, "legacy")
    data = con.blank_out(data, ["lvl_a", "c_mktsegment"], non_boolean=["lvl_a", "c_mktsegment"])
    data = con.clip_columns(data, {"cont": (10_000.0, 400_000.0)})
    data = con.round_columns(con.bool_to_int(data), ["cont"], 4)
    data = con.fact_aliases(data, "exposure", "incurred_act", "exposure", "offset_all")
    train, _ = asm.split(data, F.col("train"))
    rows = con.model_prep(train, ["flag"], "num", "denom", "weight", "offset", keep=["o_orderkey"])
    model = md.fit_tweedie(
        rows, ["flag"], "target", "weight", method="boost", rounds=1, max_depth=1, learning_rate=0.3
    )
    scored = ev.prediction_facts(md.score(model, rows), "num", "denom", "offset")
    paid = stage(asm.join_new_columns(scored, b.premium(spark, sf_dir), "o_orderkey"), "paid")
    table = ev.lift(paid, "weight", "o_orderkey", variant="premium", base="pred", premium="ep")
    return tidy(
        table.select("decile", F.col("weight").alias("exposure"), "act", "pred", "act_rel", "pred_rel")
    )
