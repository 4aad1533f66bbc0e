"""Model queries. One-factor models have closed forms, which the SQL states."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from liftworks.functions import one_hot
from liftworks.operators import condition as con
from liftworks.operators import evaluate as ev
from liftworks.operators import model as md
from liftworks.plans import bindings as b
from liftworks.plans.registry.core import FEATURES_SQL, POLICY_SQL, query, tidy, with_views
from liftworks.sources import stage

_PRIORITIES = ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_FACTORS = tuple(f"o_orderpriority__{c}" for c in _PRIORITIES)

_RATED_SQL = """
rated AS (
  SELECT o_orderkey, f.fold, o_orderpriority, flag, exposure,
         CAST(incurred_act AS DOUBLE) / exposure AS target
  FROM features f JOIN policy USING (o_orderkey))"""


def _rated(spark, sf_dir):
    """Order grain: features, rate target and exposure."""
    feats = con.bool_to_int(b.features(spark, sf_dir))
    facts = b.policy(spark, sf_dir).select("o_orderkey", "incurred_act", "exposure", "offset_f")
    rated = ev.rate_target(feats.join(facts, "o_orderkey"), "incurred_act", "exposure")
    hot = one_hot(F.col("o_orderpriority"), "o_orderpriority", _PRIORITIES)
    return stage(con.fill_missing(rated, ["lvl_b"]).select("*", *hot), "rated")


def _r(expr, digits):
    return f"(round_even(({expr}) * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE)"


_LEVELS_SQL = """
levels AS (
  SELECT o_orderpriority, sum(exposure * target) / sum(exposure) AS mu FROM rated
  WHERE fold <= 5 GROUP BY o_orderpriority)"""


@query(
    "tweedie_glm_score",
    with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL, _LEVELS_SQL)
    + f"""
SELECT o_orderkey, {_r('mu', 3)} AS pred FROM rated JOIN levels USING (o_orderpriority)""",
)
def tweedie_glm_score(spark, sf_dir):
    """One-factor GLM: the fitted level is the weighted mean rate of the training rows."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(rated.filter("fold <= 5"), _FACTORS, "target", "exposure")
    return tidy(md.score(model, rated).select("o_orderkey", "pred"), 3)


@query(
    "contrib_linear",
    with_views(
        FEATURES_SQL, POLICY_SQL, _RATED_SQL, _LEVELS_SQL,
        """
coef AS (
  SELECT l.o_orderpriority, ln(l.mu) - ln(z.mu) AS c,
         (SELECT avg(CAST(r.o_orderpriority = l.o_orderpriority AS DOUBLE)) FROM rated r WHERE fold <= 5) AS m
  FROM levels l, levels z WHERE z.o_orderpriority = '1-URGENT')""",
    )
    + f"""
SELECT o_orderkey, CAST(exposure AS DOUBLE) AS weight,
       {_r("(SELECT ln(mu) FROM levels WHERE o_orderpriority = '1-URGENT') + (SELECT sum(c * m) FROM coef)", 5)}
         AS base_value,
       """
    + ", ".join(
        f"""(SELECT {_r(f"c * (CAST(r.o_orderpriority = '{p}' AS DOUBLE) - m)", 5)} FROM coef
        WHERE coef.o_orderpriority = '{p}') AS "o_orderpriority__{p}" """
        for p in _PRIORITIES
    )
    + " FROM rated r",
)
def contrib_linear(spark, sf_dir):
    """Contributions of the one-factor GLM: log rate relativities, centred on the training rows."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(rated.filter("fold <= 5"), _FACTORS, "target", "exposure")
    return tidy(model.contributions(rated, "o_orderkey", "exposure"), 5)


def _stump_rounds_sql(rounds: int, rated: str = "rated", feature: str = "flag") -> str:
    """Margins of boosted trees on one feature, a leaf per level: one Newton step per level and round."""
    views = [
        f"""
m0 AS (
  SELECT *, (SELECT ln(sum(exposure * target) / sum(exposure)) FROM {rated}) AS f,
         0.0::DOUBLE AS v, 0.0::DOUBLE AS e
  FROM {rated})"""
    ]
    for i in range(1, rounds + 1):
        views.append(
            f"""
s{i} AS (
  SELECT {feature}, sum(exposure * (exp(0.5 * f) - target * exp(-0.5 * f))) AS g,
         sum(exposure * (0.5 * exp(0.5 * f) + 0.5 * target * exp(-0.5 * f))) AS h
  FROM m{i - 1} GROUP BY {feature}),
l{i} AS (SELECT {feature}, h, -0.3::DOUBLE * g / (h + 1.0) AS leaf FROM s{i}),
x{i} AS (SELECT sum(h * leaf) / sum(h) AS expected FROM l{i}),
m{i} AS (
  SELECT m.* REPLACE (m.f + leaf AS f, m.v + leaf AS v, m.e + expected AS e)
  FROM m{i - 1} m JOIN l{i} l ON m.{feature} IS NOT DISTINCT FROM l.{feature} CROSS JOIN x{i})"""
        )
    return ",".join(views)


_STUMP_SQL = with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL, _stump_rounds_sql(3))
_STUMP = {"method": "boost", "rounds": 3, "max_depth": 1, "learning_rate": 0.3, "stage_every": 2}


@query("tweedie_boost_stump", _STUMP_SQL + f" SELECT o_orderkey, {_r('exp(f)', 4)} AS pred FROM m3")
def tweedie_boost_stump(spark, sf_dir):
    """Three boosting rounds of stumps on one feature."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(rated, ["flag"], "target", "exposure", **_STUMP)
    return tidy(md.score(model, rated).select("o_orderkey", "pred"), 4)


@query(
    "contrib_stump",
    _STUMP_SQL
    + f"""
SELECT o_orderkey, {_r('v - e', 6)} AS flag, {_r('f - v + e', 6)} AS base_value,
       CAST(exposure AS DOUBLE) AS weight FROM m3""",
)
def contrib_stump(spark, sf_dir):
    """Tree contributions of the one-feature ensemble: leaf value less its expectation."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(rated, ["flag"], "target", "exposure", **_STUMP)
    return tidy(model.contributions(rated, "o_orderkey", "exposure"))


# --- trees of depth 2 on two 0/1 features: four cells, each with its own Newton step ------------

_PAIR = ("flag", "high")
_PAIR_OPTIONS = {"method": "boost", "rounds": 5, "max_depth": 2, "learning_rate": 0.2, "alpha": 0.25}
_PAIRED_SQL = """
paired AS (
  SELECT *, CAST(flag AS INTEGER) AS a, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS b FROM rated)"""


def _shrunk(g: str) -> str:
    return f"greatest(abs({g}) - 0.25, 0.0)"


def _cell_rounds_sql(rounds: int) -> str:
    """Per round and cell: sums, leaf, and Shapley values of the tree, whose root is the feature of
    higher gain."""
    views = [
        """
m0 AS (
  SELECT a, b, (SELECT ln(sum(exposure * target) / sum(exposure)) FROM paired WHERE fold <= 5) AS f,
         0.0::DOUBLE AS pa, 0.0::DOUBLE AS pb, 0.0::DOUBLE AS e
  FROM (SELECT DISTINCT a, b FROM paired))"""
    ]
    for i in range(1, rounds + 1):
        gains = {
            k: f"(SELECT sum({_shrunk('g')} ** 2 / (h + 1.0)) FROM (SELECT {k}, sum(g) AS g, sum(h) AS h FROM s{i} GROUP BY {k}))"
            for k in "ab"
        }
        views.append(
            f"""
s{i} AS (
  SELECT a, b, sum(exposure * (exp(0.5 * f) - target * exp(-0.5 * f))) AS g,
         sum(exposure * (0.5 * exp(0.5 * f) + 0.5 * target * exp(-0.5 * f))) AS h
  FROM paired JOIN m{i - 1} USING (a, b) WHERE fold <= 5 GROUP BY a, b),
l{i} AS (SELECT a, b, h, -0.2::DOUBLE * sign(g) * {_shrunk('g')} / (h + 1.0) AS leaf FROM s{i}),
r{i} AS (SELECT {gains['a']} >= {gains['b']} AS a_first, sum(h) AS h, sum(h * leaf) / sum(h) AS e FROM l{i}),
v{i} AS (
  SELECT x.a, x.b, x.leaf, r.e,
         CASE WHEN r.a_first
              THEN (SELECT sum(y.h * y.leaf) / sum(y.h) FROM l{i} y WHERE y.a = x.a)
              ELSE (SELECT sum(y.leaf * (SELECT sum(z.h) FROM l{i} z WHERE z.b = y.b)) FROM l{i} y WHERE y.a = x.a) / r.h
         END AS va,
         CASE WHEN r.a_first
              THEN (SELECT sum(y.leaf * (SELECT sum(z.h) FROM l{i} z WHERE z.a = y.a)) FROM l{i} y WHERE y.b = x.b) / r.h
              ELSE (SELECT sum(y.h * y.leaf) / sum(y.h) FROM l{i} y WHERE y.b = x.b)
         END AS vb
  FROM l{i} x CROSS JOIN r{i} r),
m{i} AS (
  SELECT a, b, f + v.leaf AS f, pa + (v.va - v.e + v.leaf - v.vb) / 2 AS pa,
         pb + (v.vb - v.e + v.leaf - v.va) / 2 AS pb, m.e + v.e AS e
  FROM m{i - 1} m JOIN v{i} v USING (a, b))"""
        )
    return ",".join(views)


_CELLS_SQL = with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL, _PAIRED_SQL, _cell_rounds_sql(5))


def _boosted(spark, sf_dir):
    rated = _rated(spark, sf_dir).withColumn("high", (F.col("o_orderpriority") == "2-HIGH").cast("int"))
    return rated, md.fit_tweedie(rated.filter("fold <= 5"), _PAIR, "target", "exposure", **_PAIR_OPTIONS)


@query(
    "tweedie_boost_score",
    _CELLS_SQL + f" SELECT o_orderkey, {_r('exp(f)', 4)} AS pred FROM paired JOIN m5 USING (a, b)",
)
def tweedie_boost_score(spark, sf_dir):
    rated, model = _boosted(spark, sf_dir)
    return tidy(md.score(model, rated).select("o_orderkey", "pred"), 4)


@query(
    "contrib_tree",
    _CELLS_SQL
    + f"""
SELECT o_orderkey, {_r('pa', 6)} AS flag, {_r('pb', 6)} AS high,
       {_r('e + (SELECT ln(sum(exposure * target) / sum(exposure)) FROM paired WHERE fold <= 5)', 6)} AS base_value,
       CAST(exposure AS DOUBLE) AS weight
FROM paired JOIN m5 USING (a, b)""",
)
def contrib_tree(spark, sf_dir):
    rated, model = _boosted(spark, sf_dir)
    return tidy(model.contributions(rated, "o_orderkey", "exposure"))


# --- a feature with missing values, whose rows differ from all others ----------------------------

_GAPPED_SQL = """
gapped AS (
  SELECT *, CASE o_orderpriority WHEN '2-HIGH' THEN NULL WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 0 ELSE 1 END AS x
  FROM rated)"""
_GAP_SIDES_SQL = """
start AS (SELECT ln(sum(exposure * target) / sum(exposure)) AS f FROM gapped),
sums AS (
  SELECT x, sum(exposure * (exp(0.5 * f) - target * exp(-0.5 * f))) AS g,
         sum(exposure * (0.5 * exp(0.5 * f) + 0.5 * target * exp(-0.5 * f))) AS h
  FROM gapped, start GROUP BY x),
options AS (
  SELECT o.turn, s.x, s.g, s.h, CASE o.turn WHEN 1 THEN s.x IS NOT DISTINCT FROM 0
         WHEN 2 THEN coalesce(s.x, 0) = 0 ELSE s.x IS NOT NULL END AS is_left
  FROM sums s, (VALUES (1), (2), (3)) o(turn)),
sides AS (SELECT turn, is_left, sum(g) AS g, sum(h) AS h FROM options GROUP BY turn, is_left),
best AS (
  SELECT turn FROM (SELECT turn, sum(g * g / (h + 1.0)) AS worth FROM sides GROUP BY turn)
  ORDER BY worth DESC, turn LIMIT 1)"""


def _gapped(spark, sf_dir):
    """Missing is null for even keys, NaN for odd ones."""
    priority = F.col("o_orderpriority")
    gap = F.when(F.col("o_orderkey") % 2 == 0, None).otherwise(F.lit(float("nan")))
    level = F.when(priority.isin("1-URGENT", "5-LOW"), 0.0).otherwise(1.0)
    return _rated(spark, sf_dir).withColumn("x", F.when(priority == "2-HIGH", gap).otherwise(level))


@query(
    "tweedie_boost_missing",
    with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL, _GAPPED_SQL, _GAP_SIDES_SQL)
    + f"""
SELECT r.o_orderkey, {_r('exp(f - 0.3 * s.g / (s.h + 1.0))', 4)} AS pred
FROM gapped r, start, best b
JOIN options o ON o.turn = b.turn AND o.x IS NOT DISTINCT FROM r.x
JOIN sides s ON s.turn = b.turn AND s.is_left = o.is_left""",
)
def tweedie_boost_missing(spark, sf_dir):
    """A stump on a feature with gaps: rows without a value go to the side that gains more, or alone."""
    rated = _gapped(spark, sf_dir)
    model = md.fit_tweedie(
        rated, ["x"], "target", "exposure", method="boost", rounds=1, max_depth=1, learning_rate=0.3
    )
    return tidy(md.score(model, rated).select("o_orderkey", "pred"), 4)


@query(
    "contrib_missing",
    with_views(
        FEATURES_SQL, POLICY_SQL, _RATED_SQL, _GAPPED_SQL,
        _stump_rounds_sql(3, "gapped", "x"),
    )
    + f"""
SELECT o_orderkey, {_r('v - e', 6)} AS x, {_r('f - v + e', 6)} AS base_value, CAST(exposure AS DOUBLE) AS weight
FROM m3""",
)
def contrib_missing(spark, sf_dir):
    """Two levels of splits tell rows without a value from both others: a leaf for each of the three."""
    rated = _gapped(spark, sf_dir)
    model = md.fit_tweedie(
        rated, ["x"], "target", "exposure", method="boost", rounds=3, max_depth=2, learning_rate=0.3, keep_every=2
    )
    return tidy(model.contributions(rated, "o_orderkey", "exposure"))


_TREE_FEATURES = ("lvl_a", "lvl_b", "flag", "cont")


@query(
    "tweedie_boost_additive",
    with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL)
    + " SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS off, CAST(0 AS BIGINT) AS thin FROM rated",
)
def tweedie_boost_additive(spark, sf_dir):
    """Deeper trees on all features: rows whose contributions don't add up to the margin, and nodes
    lighter than allowed."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(
        rated.filter("fold <= 5"), _TREE_FEATURES, "target", "exposure",
        method="boost", rounds=3, max_depth=3, learning_rate=0.2, min_child_weight=500.0,
    )
    both = model.contributions(rated, "o_orderkey").join(md.score(model, rated).select("o_orderkey", "pred"), "o_orderkey")
    total = sum((F.col(c) for c in _TREE_FEATURES), F.col("base_value"))
    thin = sum(n.cover < 500.0 for t in model.trees for n in t.nodes)
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(total - F.log("pred")) > 1e-9).alias("off"),
        F.lit(thin).cast("long").alias("thin"),
    )


@query(
    "tweedie_boost_min_child",
    with_views(FEATURES_SQL, POLICY_SQL, _RATED_SQL)
    + f"""
SELECT o_orderkey, (SELECT {_r('m + 0.5 * -sign(g) * greatest(abs(g) - 0.25, 0.0) / (h + 1.0)', 6)} FROM (
  SELECT m, sum(exposure * (exp(0.5 * m) - target * exp(-0.5 * m))) AS g,
         sum(exposure * (0.5 * exp(0.5 * m) + 0.5 * target * exp(-0.5 * m))) AS h
  FROM rated, (SELECT ln(sum(exposure * target) / sum(exposure)) AS m FROM rated) GROUP BY m)) AS margin
FROM rated""",
)
def tweedie_boost_min_child(spark, sf_dir):
    """A child weight above the total curvature: the tree is a single leaf."""
    rated = _rated(spark, sf_dir)
    model = md.fit_tweedie(
        rated, _TREE_FEATURES, "target", "exposure", method="boost", rounds=1, max_depth=3,
        learning_rate=0.5, alpha=0.25, min_child_weight=1e15,
    )
    return tidy(md.score(model, rated).select("o_orderkey", F.log("pred").alias("margin")))


@query(
    "tweedie_boost_monotone",
    "SELECT d AS direction, CAST(6 AS BIGINT) AS levels, CAST(0 AS BIGINT) AS violations FROM (VALUES (-1), (1)) t(d) "
    "WHERE (SELECT count(DISTINCT o_orderkey % 6) FROM orders) = 6",
)
def tweedie_boost_monotone(spark, sf_dir):
    """Fits bound to a direction in one feature: levels whose score moves the other way, at equal
    values of the other features."""
    rated = _rated(spark, sf_dir)
    out = None
    for direction in (-1, 1):
        model = md.fit_tweedie(
            rated, ("lvl_a", "flag"), "target", "exposure", method="boost", rounds=4, max_depth=3,
            learning_rate=0.3, monotone=[direction, 0],
        )
        levels = md.score(model, rated.select("lvl_a", "flag").distinct())
        window = Window.partitionBy("flag").orderBy("lvl_a")  # six levels
        step = (F.col("pred") - F.lag("pred").over(window)) * direction
        row = levels.withColumn("wrong", F.coalesce(step < -1e-12, F.lit(False))).agg(
            F.lit(direction).alias("direction"), F.count_distinct("lvl_a").alias("levels"),
            F.count_if("wrong").alias("violations"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "monotone_check",
    with_views(
        POLICY_SQL,
        """
lev AS (
  SELECT CAST(o_orderkey % 6 AS DOUBLE) AS lo,
         CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS p
  FROM policy GROUP BY 1)""",
    )
    + f"""
SELECT lo, lo AS hi, {_r('p', 6)} AS pred, coalesce(p < lag(p) OVER (ORDER BY lo), false) AS violation
FROM lev""",
)
def monotone_check(spark, sf_dir):
    scored = b.policy(spark, sf_dir).withColumn("lvl_a", F.col("o_orderkey") % 6)
    return tidy(md.monotone_check(scored, "lvl_a", "exposure", 1))


@query(
    "monotone_check_all",
    with_views(
        POLICY_SQL,
        " UNION ALL ".join([
            """
lev AS (
  SELECT 'lvl_a' AS field, CAST(o_orderkey % 6 AS DOUBLE) AS lo, 1 AS d,
         CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS p
  FROM policy GROUP BY o_orderkey % 6""",
            """
  SELECT 'lvl_c', CAST(o_orderkey % 4 AS DOUBLE), -1, CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)
  FROM policy GROUP BY o_orderkey % 4)""",
        ]),
    )
    + f"""
SELECT field, lo, lo AS hi, {_r('p', 6)} AS pred,
       coalesce((p - lag(p) OVER (PARTITION BY field ORDER BY lo)) * d < 0, false) AS violation
FROM lev""",
)
def monotone_check_all(spark, sf_dir):
    levels = {"lvl_a": F.col("o_orderkey") % 6, "lvl_c": F.col("o_orderkey") % 4}
    scored = b.policy(spark, sf_dir).withColumns(levels)
    return tidy(md.monotone_check_all(scored, {"lvl_a": 1, "lvl_c": -1}, "exposure"))
