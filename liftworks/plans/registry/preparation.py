"""Preparation queries: catalogs, assembly, conditioning, model input."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftworks.functions import round_step
from liftworks.operators import assemble as asm
from liftworks.operators import catalog as cat
from liftworks.operators import condition as con
from liftworks.operators import evaluate as ev
from liftworks.plans import bindings as b
from liftworks.plans.registry.core import (
    AUX_SQL,
    CONTRIB_SQL,
    FEATURES_SQL,
    MASTER_SQL,
    POLICY_SQL,
    PREMIUM_SQL,
    query,
    r6,
    tidy,
    with_views,
)
from liftworks.sources import join_keyed, keyed

# --- catalogs, joined with what the rows say about the columns --------------------------------

_MASTER_TYPES = {
    "vin_date": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int32",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "raw_num": "string", "disc_n": "double",
    "p_size": "int32", "p_brand": "string", "p_type": "string", "p_name": "string",
}
_PROFILE_SQL = "profile AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) FILTER ({c} IS NULL) AS missing FROM master"
    for c, t in _MASTER_TYPES.items()
) + ")"


def _profile(spark, sf_dir):
    df = b.master(spark, sf_dir)
    return cat.export_schema(df).join(con.missing_profile(df), "column_name", "left").select(
        "column_name", "dtype", F.coalesce("missing", F.lit(0).cast("bigint")).alias("missing")
    )


@query("schema_catalog", with_views(MASTER_SQL, _PROFILE_SQL) + " SELECT * FROM profile")
def schema_catalog(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(
    "type_distribution",
    with_views(MASTER_SQL, _PROFILE_SQL)
    + """
SELECT dtype, count(*) AS columns, CAST(sum(missing) AS BIGINT) AS missing
FROM profile GROUP BY dtype""",
)
def type_distribution(spark, sf_dir):
    profile = _profile(spark, sf_dir)
    missing = profile.groupBy("dtype").agg(F.sum("missing").alias("missing"))
    return cat.type_distribution(profile).join(missing, "dtype")


_INCLUSION = ("l_quantity", "disc_n", "p_size", "vc_absent")


@query(
    "load_plan",
    with_views(MASTER_SQL)
    + """
SELECT 'vin_date' AS column_name, 'essential' AS source, count(vin_date) AS present FROM master
UNION ALL SELECT 'l_quantity', 'feature', count(l_quantity) FROM master
UNION ALL SELECT 'disc_n', 'feature', count(disc_n) FROM master
UNION ALL SELECT 'p_size', 'feature', count(p_size) FROM master
UNION ALL SELECT 'vin', 'essential', CAST(0 AS BIGINT)
UNION ALL SELECT 'vc_absent', 'feature', CAST(0 AS BIGINT)""",
)
def load_plan(spark, sf_dir):
    """The plan, and how many values each planned column holds in a scan pruned to the plan."""
    df = b.master(spark, sf_dir)
    sheet = spark.createDataFrame([(c,) for c in _INCLUSION], "column_name string")
    plan, absent = cat.load_plan(cat.export_schema(df), sheet, ["vin_date", "vin"])
    names = cat.included(df.columns, ["vin_date", *_INCLUSION])
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    present = counts.unpivot([], names, "column_name", "present")
    counted = plan.unionByName(absent).join(present, "column_name", "left")
    return counted.select("column_name", "source", F.coalesce("present", F.lit(0).cast("bigint")).alias("present"))


@query(
    "load_reduction",
    with_views(MASTER_SQL)
    + f"""
SELECT CAST(16 AS BIGINT) AS total, CAST(4 AS BIGINT) AS loaded, CAST(12 AS BIGINT) AS skipped,
       75.0::DOUBLE AS reduction_pct, count(*) AS rows,
       {r6('sum(CAST(disc_n AS DECIMAL(18,2)))')} AS disc_n
FROM master""",
)
def load_reduction(spark, sf_dir):
    df = b.master(spark, sf_dir)
    catalog = cat.export_schema(df)
    sheet = spark.createDataFrame([(c,) for c in _INCLUSION], "column_name string")
    plan, _ = cat.load_plan(catalog, sheet, ["vin_date", "vin"])
    loaded = df.select(*cat.included(df.columns, ["vin_date", *_INCLUSION]))
    seen = loaded.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("disc_n").cast("decimal(18,2)")).alias("disc_n")
    )
    out = cat.load_reduction(catalog, plan)
    return tidy(out.crossJoin(F.broadcast(seen)))  # one row each


@query(
    "leakage_scan",
    with_views(POLICY_SQL)
    + """
SELECT 'incurred_act' AS column_name, 'incurred' AS pattern, true AS leaker,
       'incurred_act,data_leakage,leakage' AS csv_row, count(*) FILTER (incurred_act <> 0) AS used
FROM policy
UNION ALL
SELECT 'incurred_pred', 'incurred', false, NULL, count(*) FILTER (incurred_pred <> 0) FROM policy""",
)
def leakage_scan(spark, sf_dir):
    """Suspicious columns by name, with the number of rows in which they carry a value."""
    df = b.policy(spark, sf_dir)
    known = spark.createDataFrame([("incurred_pred",)], "column_name string")
    found = cat.leakage_scan(cat.export_schema(df), known)
    names = [c for c in df.columns if c.startswith(cat.LEAKAGE_PATTERNS)]
    used = df.agg(*[F.count(F.when(F.col(c) != 0, 1)).alias(c) for c in names])
    return found.join(used.unpivot([], names, "column_name", "used"), "column_name")


@query(
    "select_facts",
    with_views(MASTER_SQL)
    + f"""
SELECT count(*) AS rows, CAST(sum(l_quantity) AS BIGINT) AS l_quantity,
       {r6('sum(CAST(l_discount AS DECIMAL(18,2)))')} AS l_discount,
       {r6('sum(CAST(l_tax AS DECIMAL(18,2)))')} AS l_tax
FROM master""",
)
def select_facts(spark, sf_dir):
    """Columns picked by name and type, dropped and kept by list, then summed."""
    df = con.drop_if_present(b.master(spark, sf_dir), ["p_name", "vc_absent"])
    facts, features = cat.facts_and_features(df.columns, ["_quantity", "_discount", "_tax"], ["vin_date"])
    numeric = set(cat.numeric_columns(df, exclude=features))
    kept = con.keep_selected(df, ["vin_date"], [c for c in facts if c in numeric])
    sums = {"l_quantity": "bigint", "l_discount": "decimal(18,2)", "l_tax": "decimal(18,2)"}
    return tidy(
        kept.agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).cast(t)).alias(c) for c, t in sums.items()]
        )
    )


# --- assembly ---------------------------------------------------------------------------------


@query(
    "assemble_inner",
    with_views(MASTER_SQL, AUX_SQL)
    + f"""
SELECT vin_date, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, fold, pp,
       {r6('dep_factor')} AS dep_factor
FROM master JOIN aux USING (vin_date) WHERE fold IN (1, 6)""",
)
def assemble_inner(spark, sf_dir):
    aux = b.aux(spark, sf_dir).withColumnRenamed("vin_date", "VIN_Date")
    folds = asm.folds_for(1, {1: [1], 2: [1, 2], 0: list(b.TRAIN_FOLDS)}, b.TEST_FOLD)
    joined = asm.assemble(b.master(spark, sf_dir), asm.fold_filter(aux, folds), "vin_date")
    return tidy(
        joined.select(
            F.col("VIN_Date").alias("vin_date"), "l_linenumber", "l_partkey", "l_suppkey",
            "l_extendedprice", "p_brand", "fold", "pp", "dep_factor",
        )
    )


@query(
    "assemble_overlap",
    with_views(MASTER_SQL, AUX_SQL)
    + """
SELECT o_orderstatus AS status, count(*) AS rows,
       count(*) FILTER (fold_x = fold_y) AS same_fold
FROM (SELECT vin_date, vin_date % 6 AS fold_x FROM master) m
JOIN (SELECT vin_date, fold AS fold_y, o_orderstatus FROM aux) a USING (vin_date)
GROUP BY o_orderstatus""",
)
def assemble_overlap(spark, sf_dir):
    master = b.master(spark, sf_dir).select("vin_date", (F.col("vin_date") % 6).alias("fold"))
    joined = asm.assemble(master, b.aux(spark, sf_dir), "vin_date")
    return joined.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("fold_x") == F.col("fold_y"), 1)).alias("same_fold"),
    )


@query(
    "keyed_joins",
    with_views(MASTER_SQL, AUX_SQL, POLICY_SQL, PREMIUM_SQL, CONTRIB_SQL)
    + f"""
SELECT vin_date, l_linenumber, p_brand, m.fold, {r6('ep')} AS ep, {r6('c.cont')} AS cont, weight
FROM (SELECT * FROM master JOIN aux USING (vin_date)) m
LEFT JOIN premium p ON p.o_orderkey = vin_date
LEFT JOIN contrib c ON c.o_orderkey = vin_date""",
)
def keyed_joins(spark, sf_dir):
    """Master, folds, premiums and contributions on one key; shuffled once each, when written."""
    key = "vin_date"
    lines = keyed(b.master(spark, sf_dir).select(key, "l_linenumber", "p_brand"), key)
    folds = keyed(b.aux(spark, sf_dir).select(key, "fold"), key)
    premium = keyed(b.premium(spark, sf_dir).withColumnRenamed("o_orderkey", key), key)
    effects = b.contributions(spark, sf_dir).select(F.col("o_orderkey").alias(key), "cont", "weight")
    return tidy(join_keyed(lines, folds, premium, keyed(effects, key), how="left"))


@query(
    "keyed_hot_key",
    """
WITH lines AS (
  SELECT CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber = 6 THEN NULL ELSE l_partkey END AS part,
         l_quantity
  FROM lineitem)
SELECT p_brand, coalesce(p_size % 10, -1) AS size, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity,
       count(part) AS keyed
FROM lines LEFT JOIN part ON part = p_partkey GROUP BY ALL""",
)
def keyed_hot_key(spark, sf_dir):
    """A key that a third of all lines share is dealt over the tasks; lines without one stay."""
    n = F.col("l_linenumber")
    part = F.when(n <= 2, 1).when(n == 6, None).otherwise(F.col("l_partkey")).cast("bigint").alias("part")
    lines = keyed(b.table(spark, sf_dir, "lineitem").select(part, "l_quantity"), "part", hot_rows=1000)
    parts = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("part"), "p_brand", (F.col("p_size") % 10).alias("size")
    )
    joined = join_keyed(lines, keyed(parts, "part", hot_rows=1000), how="left")
    return joined.groupBy("p_brand", F.coalesce("size", F.lit(-1)).alias("size")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.count("part").alias("keyed"),
    )


@query(
    "fold_counts",
    with_views(AUX_SQL)
    + """
SELECT fold, count(*) AS rows,
       CASE WHEN fold IN (1, 2) THEN 'TRAIN' WHEN fold = 6 THEN 'TEST' ELSE 'other' END AS role
FROM aux GROUP BY fold""",
)
def fold_counts(spark, sf_dir):
    return con.fold_counts(b.aux(spark, sf_dir), [1, 2], 6)


@query(
    "premium_left_join",
    with_views(POLICY_SQL, PREMIUM_SQL)
    + f"""
SELECT o_orderkey, exposure, {r6('ep')} AS ep FROM policy LEFT JOIN premium USING (o_orderkey)""",
)
def premium_left_join(spark, sf_dir):
    facts = b.policy(spark, sf_dir).select("o_orderkey", "exposure")
    return tidy(asm.join_new_columns(facts, b.premium(spark, sf_dir), "o_orderkey"))


@query(
    "train_test_split",
    with_views(POLICY_SQL)
    + """
SELECT 'flag' AS kind, 'train' AS part, count(*) AS rows, CAST(sum(exposure) AS BIGINT) AS exposure
FROM policy WHERE train
UNION ALL SELECT 'flag', 'test', count(*), CAST(sum(exposure) AS BIGINT) FROM policy WHERE NOT train
UNION ALL SELECT 'fold', 'train', count(*), CAST(sum(exposure) AS BIGINT) FROM policy WHERE fold IN (1, 2)
UNION ALL SELECT 'fold', 'test', count(*), CAST(sum(exposure) AS BIGINT) FROM policy WHERE fold = 6""",
)
def train_test_split(spark, sf_dir):
    df = b.policy(spark, sf_dir)
    conditions = {
        ("flag", "train"): F.col("train"),
        ("flag", "test"): ~F.col("train"),
        ("fold", "train"): F.col("fold").isin(1, 2),
        ("fold", "test"): F.col("fold") == 6,
    }
    sums = {  # one pass for all parts
        k: F.struct(
            F.lit(k[0]).alias("kind"), F.lit(k[1]).alias("part"), F.count_if(c).alias("rows"),
            F.sum(F.when(c, F.col("exposure"))).alias("exposure"),
        )
        for k, c in conditions.items()
    }
    return df.agg(F.array(*sums.values()).alias("parts")).select(F.inline("parts"))


@query(
    "first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000",
)
def first_rows(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return asm.first_rows(orders, "o_orderkey", 1000)


_DRAW = "md5('42:' || CAST(o_orderkey AS VARCHAR))"


@query(
    "hash_sample",
    with_views(POLICY_SQL) + f" SELECT * FROM policy WHERE substr({_DRAW}, 1, 10) < '{round(0.2 * 2**40):010x}'",
)
def hash_sample(spark, sf_dir):
    return tidy(asm.hash_sample(b.policy(spark, sf_dir), "o_orderkey", 0.20))


@query(
    "fixed_sample",
    with_views(POLICY_SQL) + f" SELECT * FROM policy ORDER BY {_DRAW}, o_orderkey LIMIT 10000",
)
def fixed_sample(spark, sf_dir):
    return tidy(asm.fixed_sample(b.policy(spark, sf_dir), "o_orderkey", 10_000))


@query(
    "load_for_fit",
    with_views(MASTER_SQL)
    + f"""
SELECT vin_date, l_linenumber, CAST(l_partkey AS INTEGER) AS l_partkey,
       {r6('CAST(TRY_CAST(raw_num AS DOUBLE) AS FLOAT)')} AS raw_num,
       {r6('CAST(disc_n AS FLOAT)')} AS disc_n
FROM master WHERE disc_n IS NOT NULL""",
)
def load_for_fit(spark, sf_dir):
    df = b.master(spark, sf_dir).select("vin_date", "l_linenumber", "l_partkey", "raw_num", "disc_n")
    return tidy(asm.load(df, "disc_n", "vin_date", numeric_text=["raw_num"]))


# --- profiles ---------------------------------------------------------------------------------


@query(
    "missing_profile",
    with_views(MASTER_SQL)
    + f"""
SELECT 'disc_n' AS column_name, count(*) FILTER (disc_n IS NULL) AS missing,
       {r6('count(*) FILTER (disc_n IS NULL) * 100.0 / count(*)')} AS missing_pct
FROM master""",
)
def missing_profile(spark, sf_dir):
    return tidy(con.missing_profile(b.master(spark, sf_dir)))


def _r4(expr):
    return f"(round_even(CAST({expr} AS DOUBLE) * 10000.0, 0) / 10000.0)"


@query(
    "target_stats",
    with_views(AUX_SQL)
    + f"""
SELECT count(pp) AS n, {_r4('avg(pp)')} AS mean, {_r4('stddev_samp(pp)')} AS std,
       {_r4('min(pp)')} AS min, {_r4('max(pp)')} AS max, {_r4('median(pp)')} AS median
FROM aux""",
)
def target_stats(spark, sf_dir):
    return tidy(con.target_stats(b.aux(spark, sf_dir), "pp"), 4)


@query(
    "verification_report",
    with_views(AUX_SQL)
    + f"""
SELECT 'shape' AS section, 'rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM aux
UNION ALL SELECT 'shape', 'columns', 5.0::DOUBLE
UNION ALL SELECT 'target', 'mean', {_r4('avg(pp)')} FROM aux
UNION ALL SELECT 'target', 'std', {_r4('stddev_samp(pp)')} FROM aux
UNION ALL SELECT 'target', 'min', {_r4('min(pp)')} FROM aux
UNION ALL SELECT 'target', 'max', {_r4('max(pp)')} FROM aux
UNION ALL SELECT 'fold', CAST(fold AS VARCHAR), CAST(count(*) AS DOUBLE) FROM aux GROUP BY fold""",
)
def verification_report(spark, sf_dir):
    return tidy(con.verification_report(b.aux(spark, sf_dir), "pp"), 4)


@query(
    "type_conversion_detect",
    with_views(MASTER_SQL)
    + f"""
SELECT 'raw_num' AS column_name, 'object' AS source_dtype, 'numeric' AS target_dtype,
       {r6('avg(CASE WHEN TRY_CAST(raw_num AS DOUBLE) IS NULL THEN 0.0::DOUBLE ELSE 1.0 END)')}
         AS success_rate
FROM master""",
)
def type_conversion_detect(spark, sf_dir):
    return tidy(con.detect_conversions(b.master(spark, sf_dir)))


@query("distinct_folds", with_views(AUX_SQL) + " SELECT DISTINCT fold FROM aux")
def distinct_folds(spark, sf_dir):
    return con.distinct_values(b.aux(spark, sf_dir), "fold")


# --- values -----------------------------------------------------------------------------------

_LINE = ("vin_date", "l_linenumber", "l_partkey", "l_suppkey")
_LINE_SQL = "vin_date, l_linenumber, l_partkey, l_suppkey"


@query(
    "coerce_numeric",
    with_views(MASTER_SQL) + f" SELECT {_LINE_SQL}, TRY_CAST(raw_num AS DOUBLE) AS raw_num FROM master",
)
def coerce_numeric(spark, sf_dir):
    conversions = spark.createDataFrame(
        [("raw_num", "numeric"), ("p_brand", "keep"), ("vc_absent", "numeric")],
        "column_name string, target_dtype string",
    )
    df = b.master(spark, sf_dir).select(*_LINE, "raw_num")
    return con.apply_conversions(df, conversions)


@query(
    "fill_zero",
    with_views(MASTER_SQL)
    + f" SELECT {_LINE_SQL}, raw_num, coalesce(disc_n, 0.0) AS disc_n FROM master",
)
def fill_zero(spark, sf_dir):
    return con.fill_missing(b.master(spark, sf_dir).select(*_LINE, "raw_num", "disc_n"))


@query(
    "clip_bounds",
    with_views(MASTER_SQL)
    + f"""
SELECT {_LINE_SQL},
       CASE WHEN l_quantity > 40 THEN 40.0 WHEN l_quantity < 5 THEN 5.0 ELSE l_quantity END AS l_quantity,
       CASE WHEN disc_n > 0.08 THEN 0.08 WHEN disc_n < 0.02 THEN 0.02 ELSE disc_n END AS disc_n
FROM master""",
)
def clip_bounds(spark, sf_dir):
    rules = spark.createDataFrame(
        [("l_quantity", "5", "40"), ("disc_n", "0.02", "0.08"), ("vc_absent", "1", "2"), ("l_tax", None, None)],
        "feature_name string, min string, max string",
    )
    df = b.master(spark, sf_dir).select(*_LINE, "l_quantity", "disc_n")
    return tidy(con.clip_columns(df, con.clip_rules(rules)))


@query(
    "target_ceiling",
    with_views(AUX_SQL)
    + f"""
SELECT vin_date, {r6('least(CAST(pp AS FLOAT), CAST(300000 AS FLOAT))')} AS pp FROM aux""",
)
def target_ceiling(spark, sf_dir):
    df = b.aux(spark, sf_dir).select("vin_date", "pp")
    return tidy(con.cap_target(df, "pp", 300_000, ["pp"]))


@query(
    "target_cap_report",
    with_views(AUX_SQL)
    + f"""
SELECT count(*) FILTER (CAST(pp AS FLOAT) > 300000) AS capped_rows,
       {r6('count(*) FILTER (CAST(pp AS FLOAT) > 300000) * 100.0 / count(*)')} AS capped_pct
FROM aux""",
)
def target_cap_report(spark, sf_dir):
    return tidy(con.cap_report(b.aux(spark, sf_dir), "pp", 300_000))


@query(
    "round_step",
    with_views(MASTER_SQL)
    + f"""
SELECT {_LINE_SQL}, round_even(l_extendedprice / 250.0, 0) * 250.0 AS price_250,
       round_even(l_extendedprice / 3.0 * 10000.0, 0) / 10000.0 AS third
FROM master""",
)
def round_step_query(spark, sf_dir):
    df = b.master(spark, sf_dir).select(
        *_LINE,
        round_step(F.col("l_extendedprice"), 250).alias("price_250"),
        (F.col("l_extendedprice") / 3.0).alias("third"),
    )
    return con.round_columns(df, ["third", "vc_absent"], 4)


@query(
    "bool_to_int",
    with_views(FEATURES_SQL) + " SELECT o_orderkey, CAST(flag AS INTEGER) AS flag FROM features",
)
def bool_to_int(spark, sf_dir):
    return con.bool_to_int(b.features(spark, sf_dir).select("o_orderkey", "flag"))


@query(
    "blank_out_mode",
    with_views(FEATURES_SQL)
    + """
SELECT o_orderkey,
       (SELECT c_mktsegment FROM features GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS c_mktsegment,
       (SELECT lvl_b FROM features WHERE lvl_b IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS lvl_b,
       false AS flag, CAST(0 AS BIGINT) AS lvl_a, cont
FROM features""",
)
def blank_out_mode(spark, sf_dir):
    df = b.features(spark, sf_dir).select("o_orderkey", "c_mktsegment", "lvl_b", "flag", "lvl_a", "cont")
    return con.blank_out(
        df, ["c_mktsegment", "lvl_b", "flag", "lvl_a", "vc_absent"], non_boolean=["c_mktsegment", "lvl_b"]
    )


@query(
    "derive_offset",
    with_views(POLICY_SQL)
    + f"""
SELECT o_orderkey, {r6('offset_f * 1.1 * 0.9')} AS offset_all,
       {r6('incurred_act * (offset_f * 1.1 * 0.9)')} AS incurred_act_capped,
       exposure AS weight, exposure AS denom, {r6('incurred_act')} AS num,
       {r6('offset_f * 1.1 * 0.9')} AS "offset", 0 AS vc_suv
FROM policy""",
)
def derive_offset(spark, sf_dir):
    df = b.policy(spark, sf_dir).select(
        "o_orderkey", "exposure", "incurred_act", "offset_f",
        F.lit("1.1").cast("decimal(2,1)").alias("type_factor"),
        F.lit("0.9").cast("decimal(2,1)").alias("value_factor"),
    )
    out = con.derive_offset(df, ["offset_f", "type_factor", "value_factor"], "incurred_act", "offset_all")
    out = con.fact_aliases(
        con.constant_columns(out, ["vc_suv"]), "exposure", "incurred_act", "exposure", "offset_all"
    )
    return tidy(con.drop_if_present(out, ["offset_f", "type_factor", "value_factor", "exposure", "incurred_act"]))


@query(
    "downcast",
    """
SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey,
       """
    + r6("CAST(l_extendedprice AS FLOAT)")
    + " AS l_extendedprice FROM lineitem",
)
def downcast(spark, sf_dir):
    df = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    return tidy(asm.downcast(df, keep=["l_orderkey"]))


# --- model input ------------------------------------------------------------------------------


@query(
    "model_prep_rows",
    with_views(POLICY_SQL)
    + f"""
SELECT o_orderkey, fold, {r6('offset_f')} AS offset_f, {r6('incurred_act')} AS incurred_act, exposure,
       {r6('CAST(incurred_act AS DOUBLE) / exposure')} AS target
FROM policy WHERE exposure > 0 AND incurred_act >= 0""",
)
def model_prep_rows(spark, sf_dir):
    df = b.policy(spark, sf_dir)
    return tidy(
        con.model_prep(
            df, ["fold"], "incurred_act", "exposure", "exposure", "offset_f", keep=["o_orderkey"]
        )
    )


@query(
    "model_prep_agg",
    with_views(FEATURES_SQL, POLICY_SQL)
    + f""",
grouped AS (
  SELECT f.lvl_a, f.lvl_b, sum(incurred_act) AS ia, CAST(sum(exposure) AS BIGINT) AS w
  FROM features f JOIN policy p USING (o_orderkey) GROUP BY f.lvl_a, f.lvl_b)
SELECT lvl_a, coalesce(lvl_b, 0) AS lvl_b, {r6('ia')} AS incurred_act, w AS exposure,
       {r6('CAST(ia AS DOUBLE) / w')} AS target
FROM grouped WHERE w > 0 AND ia >= 0""",
)
def model_prep_agg(spark, sf_dir):
    feats = b.features(spark, sf_dir).select("o_orderkey", "lvl_a", "lvl_b")
    facts = b.policy(spark, sf_dir).select("o_orderkey", "incurred_act", "exposure")
    return tidy(
        con.model_prep(
            feats.join(facts, "o_orderkey"), ["lvl_a", "lvl_b"], "incurred_act", "exposure", "exposure",
            aggregate=True,
        )
    )


@query(
    "rate_target",
    with_views(POLICY_SQL)
    + f"""
SELECT o_orderkey, {r6('CAST(incurred_act AS DOUBLE) / exposure')} AS target FROM policy""",
)
def rate_target(spark, sf_dir):
    df = b.policy(spark, sf_dir).select("o_orderkey", "incurred_act", "exposure")
    return tidy(ev.rate_target(df, "incurred_act", "exposure").select("o_orderkey", "target"))


@query(
    "drop_incomplete",
    with_views(FEATURES_SQL) + " SELECT o_orderkey, lvl_b FROM features WHERE lvl_b IS NOT NULL",
)
def drop_incomplete(spark, sf_dir):
    return ev.drop_incomplete(b.features(spark, sf_dir).select("o_orderkey", "lvl_b"), ["lvl_b"])
