"""Contribution and settings queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftworks.operators import assemble as asm
from liftworks.operators import catalog as cat
from liftworks.operators import explain as ex
from liftworks.operators import settings as st
from liftworks.plans import bindings as b
from liftworks.plans.registry.core import CONTRIB_SQL, POLICY_SQL, query, r6, tidy, with_views

_FEATURES = b.CONTRIB_FEATURES


def _long(spark, sf_dir):
    return ex.long_contributions(
        b.contributions(spark, sf_dir), b.explained(spark, sf_dir), _FEATURES, "o_orderkey", "weight"
    )


# --- totals -----------------------------------------------------------------------------------

_TOTALS_SQL = """
totals AS (SELECT field, sum(abs(contrib) * weight) AS total_shap FROM long GROUP BY field)"""


@query(
    "contrib_aggregate",
    with_views(POLICY_SQL, CONTRIB_SQL, _TOTALS_SQL)
    + f"""
SELECT field, {r6('total_shap')} AS total_shap,
       {r6('sum(total_shap) OVER (ORDER BY total_shap DESC, field)')} AS cum_shap_abs,
       {r6('total_shap / sum(total_shap) OVER ()')} AS shap_abs_pct,
       {r6('sum(total_shap) OVER (ORDER BY total_shap DESC, field) / sum(total_shap) OVER ()')}
         AS cum_shap_abs_pct
FROM totals WHERE total_shap > 0""",
)
def contrib_aggregate(spark, sf_dir):
    return tidy(ex.contrib_aggregate(b.contributions(spark, sf_dir), _FEATURES, "weight"))


@query(
    "contrib_aggregate_numeric",
    with_views(POLICY_SQL, CONTRIB_SQL, _TOTALS_SQL)
    + f"""
SELECT * FROM (
  SELECT field, {r6('total_shap')} AS total_shap, 'double' AS dtype,
         {r6('total_shap / sum(total_shap) OVER ()')} AS shap_abs_pct,
         {r6('sum(total_shap) OVER (ORDER BY total_shap DESC, field) / sum(total_shap) OVER ()')}
           AS cum_shap_abs_pct
  FROM totals WHERE total_shap > 0 AND field <> 'flag')
WHERE field <> 'lvl_a'""",
)
def contrib_aggregate_numeric(spark, sf_dir):
    settings = spark.createDataFrame(
        [("lvl_a", "double"), ("flag", "bool"), ("cont", "double")], "field string, dtype string"
    )
    excluded = spark.createDataFrame([("lvl_a",)], "field string")
    return tidy(
        ex.contrib_aggregate_numeric(
            b.contributions(spark, sf_dir), _FEATURES, "weight", settings, excluded
        )
    )


_IMPORTANCE_SQL = """
imp AS (SELECT field, avg(abs(contrib)) AS importance FROM long GROUP BY field)"""


@query(
    "contrib_importance",
    with_views(POLICY_SQL, CONTRIB_SQL, _IMPORTANCE_SQL)
    + f"""
SELECT field, {r6('importance')} AS importance,
       {r6('importance * 100.0 / sum(importance) OVER ()')} AS pct_importance
FROM imp ORDER BY importance DESC LIMIT 2""",
)
def contrib_importance(spark, sf_dir):
    table = ex.importance(b.contributions(spark, sf_dir), _FEATURES)
    return tidy(ex.top_features(table, "pct_importance", 2))


@query(
    "contrib_pct_topn",
    with_views(
        POLICY_SQL, CONTRIB_SQL, _IMPORTANCE_SQL,
        """
pct AS (
  SELECT field, importance * 100.0 / sum(importance) OVER () AS pct_importance,
         CAST(row_number() OVER (ORDER BY importance DESC, field) AS INTEGER) AS rank FROM imp)""",
    )
    + f"""
SELECT CAST(least(rank, 2) AS INTEGER) AS rank,
       CASE WHEN rank <= 1 THEN field ELSE 'Sum of 2 other features' END AS feature,
       {r6('sum(pct_importance)')} AS pct_importance
FROM pct GROUP BY 1, 2""",
)
def contrib_pct_topn(spark, sf_dir):
    table = ex.importance(b.contributions(spark, sf_dir), _FEATURES)
    return tidy(ex.with_remainder(table, "pct_importance", 1))


# --- tables per level -------------------------------------------------------------------------


@query(
    "contrib_value_table",
    with_views(POLICY_SQL, CONTRIB_SQL)
    + f"""
SELECT field, val, {r6('round_even(contrib * 100000.0, 0) / 100000.0')} AS shap,
       CAST(sum(weight) AS BIGINT) AS weight
FROM long GROUP BY 1, 2, 3""",
)
def contrib_value_table(spark, sf_dir):
    return tidy(ex.contrib_value_table(_long(spark, sf_dir)))


_STEPS = {"lvl_a": 2, "flag": 1, "cont": 60000}


def _range_sql(where: str = "") -> str:
    return f"""
stepped AS (
  SELECT field, CASE field WHEN 'lvl_a' THEN round_even(val / 2.0, 0) * 2.0
                           WHEN 'flag' THEN round_even(val, 0)
                           ELSE round_even(val / 60000.0, 0) * 60000.0 END AS val,
         round_even(contrib * 1000.0, 0) / 1000.0 AS contrib, weight
  FROM long),
lev AS (
  SELECT field, val, contrib, CAST(sum(weight) AS BIGINT) AS weight
  FROM stepped {where} GROUP BY ALL),
placed AS (
  SELECT *, CAST(trunc(round_even(
      CAST(sum(weight) OVER (PARTITION BY field, val ORDER BY contrib) AS DOUBLE)
      / CAST(sum(weight) OVER (PARTITION BY field, val) AS DOUBLE) * 100.0, 0) / 100.0 * 100.0)
      AS INTEGER) AS ntile
  FROM lev),
ranged AS (
  SELECT field, val, ntile, sum(contrib * weight) / CAST(sum(weight) AS DOUBLE) AS shap
  FROM placed GROUP BY ALL)"""


@query(
    "contrib_range",
    with_views(POLICY_SQL, CONTRIB_SQL, _range_sql())
    + f" SELECT field, val, ntile, {r6('shap')} AS shap FROM ranged",
)
def contrib_range(spark, sf_dir):
    return tidy(ex.contrib_range(_long(spark, sf_dir), step=_STEPS))


@query(
    "contrib_range_used",
    with_views(POLICY_SQL, CONTRIB_SQL, _range_sql("WHERE contrib <> 0"))
    + f" SELECT field, val, ntile, {r6('shap')} AS shap FROM ranged",
)
def contrib_range_used(spark, sf_dir):
    return tidy(ex.contrib_range(_long(spark, sf_dir), step=_STEPS, only_used=True))


@query(
    "contrib_range_filled",
    with_views(
        POLICY_SQL, CONTRIB_SQL, _range_sql(),
        """
grid AS (
  SELECT field, val, CAST(n AS INTEGER) AS ntile
  FROM (SELECT DISTINCT field, val FROM ranged), range(0, 101) AS t(n)),
filled AS (
  SELECT g.field, g.val, g.ntile,
         (SELECT arg_max(r.shap, r.ntile) FROM ranged r
          WHERE r.field = g.field AND r.val = g.val AND r.ntile <= g.ntile) AS shap
  FROM grid g)""",
    )
    + f"""
SELECT field, val, ntile,
       {r6('coalesce(shap, min(shap) OVER (PARTITION BY field, val))')} AS shap
FROM filled QUALIFY ntile BETWEEN 5 AND 95""",
)
def contrib_range_filled(spark, sf_dir):
    return tidy(ex.fill_range(ex.contrib_range(_long(spark, sf_dir), step=_STEPS), (5, 95)))


@query(
    "contrib_weight_dist",
    with_views(POLICY_SQL, CONTRIB_SQL, _range_sql())
    + """
SELECT field, round_even(val * 10000.0, 0) / 10000.0 AS val, CAST(sum(weight) AS BIGINT) AS weight,
       CAST(sum(weight) FILTER (contrib <> 0) AS DOUBLE) AS used_weight
FROM stepped GROUP BY ALL""",
)
def contrib_weight_dist(spark, sf_dir):
    table = ex.contrib_weight_dist(_long(spark, sf_dir), step=_STEPS)
    return tidy(table.withColumn("used_weight", F.col("used_weight").cast("double")))


_VALUES_SQL = """
vals AS (
  SELECT field, val, round_even(contrib * 100000.0, 0) / 100000.0 AS shap,
         CAST(sum(weight) AS BIGINT) AS weight
  FROM coarse GROUP BY ALL)"""

# several contributions per value: values coarser than the contributions
_COARSE_SQL = """
coarse AS (
  SELECT field, CASE WHEN field = 'cont' THEN floor(val / 200000) * 200000
                     WHEN field = 'lvl_a' THEN floor(val / 2) ELSE val END AS val, contrib, weight
  FROM long)"""

_TARGETS = (0, 5, 95, 100)


def _percentiles_sql() -> str:
    per_target = []
    for p in _TARGETS:
        per_target.append(
            f"""
SELECT field, val, {p} AS target,
       max(gap) FILTER (gap < 0) AS dn, min(gap) FILTER (gap > 0) AS dp, bool_or(gap = 0) AS dz,
       min(shap) FILTER (gap = 0) AS zlo, max(shap) FILTER (gap = 0) AS zhi,
       arg_max(shap, gap) FILTER (gap < 0) AS nshap, arg_min(shap, gap) FILTER (gap > 0) AS pshap
FROM (SELECT field, val, shap, share - {p / 100!r}::DOUBLE AS gap FROM shares) GROUP BY field, val"""
        )
    return f"""
shares AS (
  SELECT field, val, shap,
         CAST(sum(weight) OVER (PARTITION BY field, val ORDER BY shap) AS DOUBLE)
         / CAST(sum(weight) OVER (PARTITION BY field, val) AS DOUBLE) AS share
  FROM vals WHERE shap <> 0),
kept AS ({' UNION ALL '.join(per_target)}),
spans AS (
  SELECT field, val, target, coalesce(dn, CASE WHEN dz THEN 0 END, dp) AS dmin,
         coalesce(dp, CASE WHEN dz THEN 0 END, dn) AS dmax,
         coalesce(nshap, zlo, pshap) AS lo, coalesce(pshap, zhi, nshap) AS hi
  FROM kept),
pct AS (
  SELECT field, val, target,
         CASE WHEN dmax = dmin AND dmax > 0 THEN hi WHEN dmax = dmin THEN NULL
              ELSE round_even(((0 - dmin) / (dmax - dmin) * lo + dmax / (dmax - dmin) * hi) * 100000.0, 0)
                   / 100000.0 END AS v
  FROM spans),
wide AS (
  SELECT field, val, {', '.join(f"max(v) FILTER (target = {p}) AS shap_p{p}" for p in _TARGETS)}
  FROM pct GROUP BY field, val)"""


_P_OUT = ", ".join(f"{r6(f'shap_p{p}')} AS shap_p{p}" for p in _TARGETS)


def _values(spark, sf_dir):
    val = (
        F.when(F.col("field") == "cont", F.floor(F.col("val") / 200000).cast("double") * 200000)
        .when(F.col("field") == "lvl_a", F.floor(F.col("val") / 2).cast("double"))
        .otherwise(F.col("val"))
    )
    return ex.contrib_value_table(_long(spark, sf_dir).withColumn("val", val))


@query(
    "contrib_percentiles",
    with_views(POLICY_SQL, CONTRIB_SQL, _COARSE_SQL, _VALUES_SQL, _percentiles_sql())
    + f" SELECT field, val, {_P_OUT} FROM wide",
)
def contrib_percentiles(spark, sf_dir):
    return tidy(ex.contrib_percentiles(_values(spark, sf_dir)))


_SUMMARY_SQL = """
summary AS (
  SELECT v.field, v.val, CAST(sum(weight) AS DOUBLE) / any_value(fw) AS pct_weight,
         CAST(sum(weight) FILTER (shap <> 0) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS pct_used,
         sum(shap * weight) FILTER (shap <> 0) / CAST(sum(weight) FILTER (shap <> 0) AS DOUBLE) AS shap_mean
  FROM vals v JOIN (SELECT field, CAST(sum(weight) AS DOUBLE) AS fw FROM vals GROUP BY field) t USING (field)
  GROUP BY v.field, v.val HAVING sum(weight) FILTER (shap <> 0) IS NOT NULL)"""
_SUMMARY_OUT = f"""field, val, {r6('pct_weight')} AS pct_weight, {r6('pct_used')} AS pct_used,
       {r6('shap_mean')} AS shap_mean, {_P_OUT}"""


@query(
    "contrib_summary",
    with_views(POLICY_SQL, CONTRIB_SQL, _COARSE_SQL, _VALUES_SQL, _percentiles_sql(), _SUMMARY_SQL)
    + f" SELECT {_SUMMARY_OUT} FROM summary JOIN wide USING (field, val)",
)
def contrib_summary(spark, sf_dir):
    return tidy(ex.contrib_summary(_values(spark, sf_dir)))


@query(
    "contrib_summary_all",
    with_views(
        POLICY_SQL, CONTRIB_SQL, _COARSE_SQL, _VALUES_SQL, _percentiles_sql(), _SUMMARY_SQL,
        """
effects AS (
  SELECT field, sum(abs(pct_weight * pct_used * shap_mean)) AS effect FROM summary
  GROUP BY field HAVING max(pct_used) > 0)""",
    )
    + f"""
SELECT {_SUMMARY_OUT}, {r6('effect')} AS field_tot_wtd_shap_abs,
       CASE field WHEN 'lvl_a' THEN 1 ELSE -1 END AS mono
FROM summary JOIN wide USING (field, val) JOIN effects USING (field) WHERE field <> 'flag'""",
)
def contrib_summary_all(spark, sf_dir):
    mono = spark.createDataFrame([("lvl_a", 1), ("cont", -1)], "field string, mono int")
    excluded = spark.createDataFrame([("flag",)], "field string")
    return tidy(ex.contrib_summary_all(_values(spark, sf_dir), mono, excluded))


@query(
    "feature_p1_p99",
    with_views(POLICY_SQL, CONTRIB_SQL)
    + """,
w AS (SELECT field, val, sum(weight) AS weight FROM long GROUP BY field, val),
s AS (
  SELECT field, val, round_even(CAST(sum(weight) OVER (PARTITION BY field ORDER BY val) AS DOUBLE)
         / CAST(sum(weight) OVER (PARTITION BY field) AS DOUBLE) * 1000.0, 0) / 1000.0 AS share
  FROM w)
SELECT field, coalesce(max(val) FILTER (share <= 0.01), min(val)) AS low,
       min(val) FILTER (share >= 0.99) AS high
FROM s GROUP BY field""",
)
def feature_p1_p99(spark, sf_dir):
    return ex.feature_bounds(_long(spark, sf_dir))


# --- settings sheets, made from the lines of the shared tables --------------------------------
#
# A sheet has one block per (return flag, line status): the rows mono, low_clip and high_clip, with
# the block's name on its first row only, as in a hand-written sheet.

_FIELDS = ("l_quantity", "l_discount", "l_tax")
_FLAGS = ("A", "N", "R")
_LINE_STATUSES = ("F", "O")


def _ranges(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        *[F.min(c).alias(f"lo_{c}") for c in _FIELDS], *[F.max(c).alias(f"hi_{c}") for c in _FIELDS]
    )


def _settings_sheet(spark, sf_dir):
    def cells(category, values):
        return F.struct(
            F.lit(category).alias("category"), *[v.cast("string").alias(c) for c, v in zip(_FIELDS, values)]
        )

    rows = F.array(
        cells("mono", [F.lit("1"), F.lit("x"), F.lit(None)]),
        cells("low_clip", [F.col(f"lo_{c}") for c in _FIELDS]),
        cells("high_clip", [F.col(f"hi_{c}") for c in _FIELDS]),
    )
    block = F.array_position(F.array(*map(F.lit, _FLAGS)), F.col("l_returnflag")) * 2 + F.when(
        F.col("l_linestatus") == "O", 1
    ).otherwise(0)
    sheet = _ranges(spark, sf_dir).select("*", F.posexplode(rows))
    first = F.col("pos") == 0
    return sheet.select(
        ((block - 2) * 3 + F.col("pos")).cast("int").alias("pos"),
        F.when(first, F.col("l_returnflag")).alias("veh_type"),
        F.when(first, F.col("l_linestatus")).alias("cov"),
        *[F.col(f"col.{c}").alias(c) for c in ("category", *_FIELDS)],
    )


def _option_sheet(spark, sf_dir):
    """Direction per return flag and field: blanked if the field can be zero, else by its range."""
    names = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.when(F.col(f"lo_{c}") == 0, "x").otherwise("-1").alias("mono"),
            )
            for c in (*_FIELDS,)
        ],
        F.struct(F.lit("vc_absent").alias("field"), F.lit("1").alias("mono")),
    )
    by_flag = _ranges(spark, sf_dir).groupBy(F.col("l_returnflag").alias("vc_Vehicle_Type_M")).agg(
        *[F.min(f"lo_{c}").alias(f"lo_{c}") for c in _FIELDS]
    )
    return by_flag.select("vc_Vehicle_Type_M", F.inline(names))


def _catalog(spark, sf_dir):
    return cat.export_schema(b.table(spark, sf_dir, "lineitem"))


# The sheet's tax direction is a gap that the fill takes from the block before.
_SHEET_SQL = """
lim AS (
  SELECT min(l_quantity) AS lq, max(l_quantity) AS hq, min(l_discount) AS ld, max(l_discount) AS hd,
         min(l_tax) AS lt, max(l_tax) AS ht
  FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'),
prev AS (
  SELECT max(l_tax) AS ht FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F'),
trim AS (
  SELECT 'l_quantity' AS field, 1.0::DOUBLE AS mono, false AS blank, lq AS low_clip, hq AS high_clip,
         'double' AS dtype FROM lim
  UNION ALL SELECT 'l_discount', NULL, true, ld, hd, 'double' FROM lim
  UNION ALL SELECT 'l_tax', prev.ht, false, lt, lim.ht, 'double' FROM lim, prev)"""


@query(
    "settings_reshape",
    with_views(_SHEET_SQL)
    + """
SELECT field, coalesce(mono, -9.0) AS mono, blank, low_clip, high_clip, dtype FROM trim""",
)
def settings_reshape(spark, sf_dir):
    table = st.reshape_settings(_settings_sheet(spark, sf_dir), _catalog(spark, sf_dir), "N", "O")
    marks = st.blanked(table).select("field", F.lit(True).alias("blank"))
    return table.join(marks, "field", "left").select(
        "field",
        F.coalesce(F.col("mono").try_cast("double"), F.lit(-9.0)).alias("mono"),
        F.coalesce("blank", F.lit(False)).alias("blank"),
        F.col("low_clip").cast("double").alias("low_clip"),
        F.col("high_clip").cast("double").alias("high_clip"),
        "dtype",
    )


@query(
    "settings_options",
    " UNION ALL ".join(
        f"""
SELECT '{c}' AS field, CASE WHEN min({c}) = 0 THEN 'x' ELSE '-1' END AS mono
FROM lineitem WHERE l_returnflag = 'R'"""
        for c in _FIELDS
    ),
)
def settings_options(spark, sf_dir):
    return st.option_settings(_option_sheet(spark, sf_dir), "R", _catalog(spark, sf_dir))


@query(
    "settings_coalesce",
    with_views(_SHEET_SQL)
    + """,
opt AS (SELECT CASE WHEN min(l_extendedprice) = 0 THEN 0 ELSE -1 END AS price FROM lineitem
        WHERE l_returnflag = 'N')
SELECT 'l_quantity' AS field, 1 AS mono FROM opt
UNION ALL SELECT 'l_discount', 0 FROM opt
UNION ALL SELECT 'l_extendedprice', price FROM opt
UNION ALL SELECT 'l_linenumber', 0 FROM opt""",
)
def settings_coalesce(spark, sf_dir):
    """Directions from the first sheet, else the second, else none."""
    trim = st.reshape_settings(_settings_sheet(spark, sf_dir), _catalog(spark, sf_dir), "N", "O")
    trim = asm.anti_filter(trim, spark.createDataFrame([("l_tax",)], "field string"), "field")
    prices = (
        b.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("vc_Vehicle_Type_M"))
        .agg(F.min("l_extendedprice").alias("lo"))
        .select(
            "vc_Vehicle_Type_M",
            F.lit("l_extendedprice").alias("field"),
            F.when(F.col("lo") == 0, "x").otherwise("-1").alias("mono"),
        )
    )
    options = st.option_settings(prices, "N", _catalog(spark, sf_dir))
    features = ["l_quantity", "l_discount", "l_extendedprice", "l_linenumber"]
    return st.monotone_directions(spark, features, trim, options)
