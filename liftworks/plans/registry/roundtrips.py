"""Sources and sinks: what is written to a fresh folder comes back as SQL says. And operators on
column catalogs, together with the rows of the columns they choose."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from liftworks.operators import assemble as asm
from liftworks.operators import catalog as cat
from liftworks.operators import evaluate as ev
from liftworks.operators import model as md
from liftworks.operators import settings as st
from liftworks.plans import bindings as b
from liftworks.plans.config import find_configs, load_config
from liftworks.plans.registry.core import FEATURES_SQL, MASTER_SQL, POLICY_SQL, query, r6, tidy, with_views
from liftworks.plans.registry.modelling import _FACTORS, _LEVELS_SQL, _RATED_SQL, _r, _rated
from liftworks.sources import (
    fresh_dir,
    read_csv,
    read_metadata_csv,
    write_csv,
    write_metrics,
    write_parquet,
)
from liftworks.sources.files import predictions


@query(
    "csv_scan",
    "SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS VARCHAR)[:10] AS o_orderdate FROM orders",
)
def csv_scan(spark, sf_dir):
    """All orders as CSV and back, by a path pattern and a declared schema."""
    orders = b.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    )
    root = fresh_dir(spark, "csv")
    orders.write.csv(f"{root}/orders_car", header=True)
    return read_csv(spark, root + "/orders_{veh_type}", orders.schema, veh_type="car")


@query(
    "metadata_csv",
    "SELECT CAST(c_custkey AS VARCHAR) AS column_name, c_mktsegment AS category FROM customer",
)
def metadata_csv(spark, sf_dir):
    """A settings sheet with a comment line for every row."""
    rows = b.table(spark, sf_dir, "customer").select(
        F.concat_ws("\n", F.concat(F.lit("# "), "c_name"), F.concat_ws(",", "c_custkey", "c_mktsegment")).alias("v")
    )
    path = fresh_dir(spark, "sheet")
    rows.write.text(path)
    return read_metadata_csv(spark, path, ["column_name", "category"])


@query(
    "csv_sink",
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def csv_sink(spark, sf_dir):
    counts = b.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    path = fresh_dir(spark, "report")
    write_csv(counts, path)
    return read_csv(spark, path, counts.schema)


@query(
    "predictions_sink",
    with_views(POLICY_SQL) + f" SELECT o_orderkey, pred, {r6('incurred_act')} AS incurred_act FROM policy",
)
def predictions_sink(spark, sf_dir):
    path = fresh_dir(spark, "predictions")
    write_parquet(predictions(b.policy(spark, sf_dir), "o_orderkey", "incurred_act"), path)
    return tidy(spark.read.parquet(path))


@query(
    "metrics_sink",
    with_views(POLICY_SQL)
    + f"""
SELECT {_r("avg(abs(e)) FILTER (train)", 3)} AS train_mae, {_r("avg(abs(e)) FILTER (NOT train)", 3)} AS test_mae,
       {_r("sqrt(avg(e * e) FILTER (train))", 3)} AS train_rmse, {_r("sqrt(avg(e * e) FILTER (NOT train))", 3)} AS test_rmse,
       count(*) FILTER (train) AS train_size, count(*) FILTER (NOT train) AS test_size, CAST(4 AS BIGINT) AS n_features
FROM (SELECT train, pred - CAST(incurred_act AS DOUBLE) AS e FROM policy)""",
)
def metrics_sink(spark, sf_dir):
    df, path = b.policy(spark, sf_dir), fresh_dir(spark, "metrics")
    write_metrics(ev.run_metrics(df, "incurred_act", "pred", F.col("train"), 4), path)
    return tidy(spark.read.json(path), 3)


@query(
    "model_roundtrip",
    with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL, _LEVELS_SQL)
    + f" SELECT o_orderkey, {_r('mu', 3)} AS pred FROM rated JOIN levels USING (o_orderpriority)",
)
def model_roundtrip(spark, sf_dir):
    """A saved and loaded model; its input columns are what is left of the table."""
    rated, path = _rated(spark, sf_dir).select("o_orderkey", "fold", "target", "exposure", *_FACTORS), fresh_dir(spark, "model")
    features = md.model_input(rated, ["o_orderkey", "fold", "target", "exposure"])
    md.save_model(spark, md.fit_tweedie(rated.filter("fold <= 5"), features, "target", "exposure"), path)
    return tidy(md.score(md.load_model(spark, path), rated).select("o_orderkey", "pred"), 3)


@query(
    "precondition_report",
    with_views(POLICY_SQL)
    + """
SELECT 'denom is not positive in ' || count(*) || ' rows' AS violation FROM policy WHERE o_orderkey % 11 = 0
UNION ALL
SELECT 'exposure is negative in ' || count(*) || ' rows' FROM policy WHERE o_orderkey % 9 = 0
UNION ALL SELECT 'a lift table takes two buckets or more'""",
)
def precondition_report(spark, sf_dir):
    df = b.policy(spark, sf_dir).withColumns({
        "denom": F.when(F.col("o_orderkey") % 11 == 0, 0).otherwise(F.col("denom")),
        "exposure": F.when(F.col("o_orderkey") % 9 == 0, -F.col("exposure")).otherwise(F.col("exposure")),
    })
    found = ev.violations(df, "exposure", 1)
    return spark.createDataFrame([(v,) for v in found], "violation string")


@query(
    "feature_sheet",
    with_views(FEATURES_SQL)
    + """
SELECT 'lvl_a' AS feature_name, 0 AS selected, 0 AS blank, count(lvl_a) AS present FROM features
UNION ALL SELECT 'lvl_b', 0, 0, count(lvl_b) FROM features""",
)
def feature_sheet(spark, sf_dir):
    """Sheet of the features with a prefix that are not excluded, and how many rows have them."""
    df = b.features(spark, sf_dir).withColumns({"lvl_secret": F.lit(1), "pp_bi": F.lit(1.0)})
    out = cat.always_excluded(["lvl_secret"])
    df = df.select(*[c for c in df.columns if c not in out])
    sheet = cat.feature_list(df, "lvl")
    names = [r["feature_name"] for r in sheet.collect()]  # one row per column
    counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature_name", "present")
    return sheet.join(counts, "feature_name")


@query(
    "direction_text",
    with_views(POLICY_SQL)
    + """
SELECT '(1, 0, -1)' AS constraints, count(*) AS rows, CAST(sum(exposure) AS BIGINT) AS exposure FROM policy""",
)
def direction_text(spark, sf_dir):
    """Directions in feature order as text, beside the rows they would bind."""
    mono = spark.createDataFrame([("c", -1), ("a", 1), ("b", 0)], "field string, mono int")
    rows = b.policy(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"), F.sum("exposure").alias("exposure"))
    return st.constraint_text(mono, ["a", "b", "c"]).crossJoin(F.broadcast(rows))  # one row each


@query(
    "config_discovery",
    "SELECT 'first' AS name, CAST(o_orderkey % 6 + 1 AS BIGINT) AS fold, count(*) AS rows FROM orders "
    "WHERE o_orderkey % 6 + 1 IN (1, 2, 6) GROUP BY 2 "
    "UNION ALL SELECT 'second', CAST(o_orderkey % 6 + 1 AS BIGINT), count(*) FROM orders "
    "WHERE o_orderkey % 6 + 1 IN (3, 6) GROUP BY 2",
)
def config_discovery(spark, sf_dir):
    """Configuration files below a folder, and the rows of the folds each would load."""
    import tempfile
    from pathlib import Path

    with tempfile.TemporaryDirectory() as base:  # configuration files are the driver's
        for name, folds in (("first", [1, 2]), ("second", [3])):
            Path(base, name).mkdir()
            Path(base, name, "config.json").write_text(json.dumps({
                "experiment": {"name": name, "target": "pp"}, "debug": {"level": 1, "fold_mapping": {"1": folds}},
                "paths": {"output_base": base}, "data": {"master_file": "m", "aux_file": "a"},
            }))
        configs = [load_config(p) for p in find_configs(base)]
    out = None
    for cfg in configs:
        folds = asm.folds_for(cfg.debug_level, cfg.fold_mapping, cfg.test_fold)
        rows = asm.fold_filter(b.aux(spark, sf_dir), folds)
        rows = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(cfg.name).alias("name"), "fold", "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "load_modes",
    with_views(MASTER_SQL)
    + f"""
SELECT 'full' AS mode, count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM master WHERE disc_n IS NOT NULL
UNION ALL
SELECT 'fraction', count(*), CAST(sum(l_linenumber) AS BIGINT) FROM master
WHERE disc_n IS NOT NULL AND substr(md5('42:' || CAST(vin_date AS VARCHAR)), 1, 10) < '{round(0.3 * 2**40):010x}'""",
)
def load_modes(spark, sf_dir):
    """Rows for a fit in full and as a fraction, with the leakage scan and the fixed text columns."""
    df = b.master(spark, sf_dir).select("vin_date", "l_linenumber", "l_suppkey", "disc_n")
    out = None
    for mode in ("full", "fraction"):
        rows = asm.load(df, "disc_n", "vin_date", mode, fraction=0.3, on_leakage="error")
        rows = rows.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("rows"), F.sum("l_linenumber").alias("lines"))
        out = rows if out is None else out.unionByName(rows)
    return out
