"""Evaluation queries: lift tables, Gini and Lorenz, residuals, error metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftworks.operators import evaluate as ev
from liftworks.plans import bindings as b
from liftworks.plans.registry.core import POLICY_SQL, PREMIUM_SQL, query, r6, tidy, with_views
from liftworks.sources import stage


def _policy(spark, sf_dir, test_only=False, columns=()):
    df = b.policy(spark, sf_dir)
    if test_only:
        df = df.filter(F.col("fold") == b.TEST_FOLD)
    return stage(df.select(*columns) if columns else df, "policy")


_FACTS = ("o_orderkey", "exposure", "denom", "incurred_act", "pred", "incurred_pred")


def _buckets_sql(source: str, rule: str, where: str = "") -> str:
    bucket = {
        "ceil": "greatest(1, least(10, CAST(ceil(cw / tw * 10) AS INTEGER)))",
        "floor": "least(10, CAST(floor(round_even(cw / tw * 100.0, 0) / 100.0 * 10) AS INTEGER) + 1)",
    }[rule]
    return f"""
run AS (
  SELECT *, CAST(sum(exposure) OVER (ORDER BY pred, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cw,
         CAST(sum(exposure) OVER () AS DOUBLE) AS tw
  FROM {source} {where}),
bucketed AS (SELECT *, {bucket} AS decile FROM run)"""


def _lift_sql(views, source, rule, where="", act_base="act", pred_base="pred", denom="denom"):
    return (
        with_views(*views, _buckets_sql(source, rule, where))
        + f""",
d AS (
  SELECT decile, CAST(sum(exposure) AS BIGINT) AS exposure,
         CAST(sum(incurred_act) AS DOUBLE) AS ia, CAST(sum(incurred_pred) AS DOUBLE) AS ip,
         CAST(sum({denom}) AS DOUBLE) AS dn
  FROM bucketed GROUP BY decile),
t AS (
  SELECT CAST(sum(incurred_act) AS DOUBLE) / CAST(sum({denom}) AS DOUBLE) AS act,
         CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum({denom}) AS DOUBLE) AS pred,
         CAST(sum(exposure) AS DOUBLE) AS w
  FROM bucketed)
SELECT d.decile, d.exposure, {r6('ia / dn')} AS act, {r6('ip / dn')} AS pred,
       {r6(f'(ia / dn) / t.{act_base}')} AS act_rel, {r6(f'(ip / dn) / t.{pred_base}')} AS pred_rel,
       {r6('d.exposure * 100.0 / t.w')} AS weight_pct
FROM d CROSS JOIN t"""
    )


_REL = ("decile", "exposure", "act", "pred", "act_rel", "pred_rel", "weight_pct")
_TEST = f"WHERE fold = {b.TEST_FOLD}"


@query("lift_fast", _lift_sql([POLICY_SQL], "policy", "ceil", _TEST, "pred", "pred"))
def lift_fast(spark, sf_dir):
    df = _policy(spark, sf_dir, test_only=True, columns=_FACTS)
    return tidy(ev.lift(df, "exposure", "o_orderkey").select(*_REL))


@query("lift_relativity_pred", _lift_sql([POLICY_SQL], "policy", "ceil"))
def lift_relativity_pred(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=_FACTS)
    return tidy(ev.lift(df, "exposure", "o_orderkey", variant="relativity").select(*_REL))


@query("lift_relativity_act", _lift_sql([POLICY_SQL], "policy", "ceil", "", "act", "act"))
def lift_relativity_act(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=_FACTS)
    out = ev.lift(df, "exposure", "o_orderkey", variant="relativity", base="act")
    return tidy(out.select(*_REL))


_PREMIUM_JOINED = """
joined AS (SELECT policy.*, ep FROM policy LEFT JOIN premium USING (o_orderkey))"""


def _with_premium(spark, sf_dir):
    from liftworks.operators.assemble import join_new_columns

    facts = b.policy(spark, sf_dir).select(*_FACTS)
    return stage(join_new_columns(facts, b.premium(spark, sf_dir), "o_orderkey"), "premium")


@query(
    "lift_earned_premium",
    _lift_sql(
        [POLICY_SQL, PREMIUM_SQL, _PREMIUM_JOINED], "joined", "ceil", "WHERE ep > 0",
        "act", "act", "ep",
    ),
)
def lift_earned_premium(spark, sf_dir):
    out = ev.lift(
        _with_premium(spark, sf_dir), "exposure", "o_orderkey",
        variant="premium", base="act", premium="ep",
    )
    return tidy(out.select(*_REL))


@query(
    "excluded_loss_share",
    with_views(POLICY_SQL, PREMIUM_SQL, _PREMIUM_JOINED)
    + f"""
SELECT count(*) FILTER (ep <= 0) AS dropped_rows,
       {r6("CAST(coalesce(sum(incurred_act) FILTER (ep <= 0), 0) AS DOUBLE) / CAST(sum(incurred_act) AS DOUBLE)")}
         AS actual_share,
       {r6("CAST(coalesce(sum(incurred_pred) FILTER (ep <= 0), 0) AS DOUBLE) / CAST(sum(incurred_pred) AS DOUBLE)")}
         AS predicted_share
FROM joined WHERE ep IS NOT NULL""",
)
def excluded_loss_share(spark, sf_dir):
    from liftworks.operators.assemble import join_new_columns

    joined = join_new_columns(
        b.policy(spark, sf_dir).select(*_FACTS), b.premium(spark, sf_dir), "o_orderkey"
    )
    return tidy(ev.excluded_loss_share(joined, "ep"))


@query(
    "lift_legacy",
    with_views(POLICY_SQL, _buckets_sql("policy", "floor"))
    + f"""
SELECT decile, CAST(sum(exposure) AS BIGINT) AS exposure,
       {r6("CAST(sum(incurred_act) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)")} AS act,
       {r6("CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)")} AS pred
FROM bucketed GROUP BY decile""",
)
def lift_legacy(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=_FACTS)
    return tidy(ev.lift(df, "exposure", "o_orderkey", variant="legacy"))


_OFFSET_FACTS = """
facts AS (
  SELECT *, incurred_act * offset_f AS ao, incurred_pred * offset_f AS po, denom * offset_f AS dof
  FROM policy)"""


@query(
    "lift_offset",
    with_views(POLICY_SQL, _OFFSET_FACTS, _buckets_sql("facts", "floor"))
    + f"""
SELECT decile, CAST(sum(exposure) AS BIGINT) AS exposure,
       {r6("CAST(sum(ao) AS DOUBLE) / CAST(sum(dof) AS DOUBLE)")} AS act,
       {r6("CAST(sum(po) AS DOUBLE) / CAST(sum(dof) AS DOUBLE)")} AS pred
FROM bucketed GROUP BY decile""",
)
def lift_offset(spark, sf_dir):
    scored = b.policy(spark, sf_dir).select("o_orderkey", "exposure", "incurred_act", "pred", "offset_f")
    facts = stage(ev.prediction_facts(scored, "incurred_act", "exposure", "offset_f"), "offset_facts")
    return tidy(ev.lift(facts, "exposure", "o_orderkey", variant="offset"))


_GINI = "1.0 - (2.0 * sum(c) - max(c) FILTER (rn = 1) - max(c) FILTER (rn = n)) / max(n)"
_TARGET = """
scored AS (
  SELECT o_orderkey, exposure, pred, incurred_act, incurred_pred, denom,
         CAST(incurred_act AS DECIMAL(24,4)) AS actual
  FROM policy)"""


def _curve_sql(source: str, actual: str, order: str) -> str:
    return f"""
curve AS (
  SELECT row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n,
         CAST(sum({actual}) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           / CAST(sum({actual}) OVER () AS DOUBLE) AS c
  FROM {source})"""


@query(
    "lift_2025",
    with_views(
        POLICY_SQL,
        _buckets_sql("policy", "floor"),
        """
d AS (
  SELECT decile, CAST(sum(exposure) AS BIGINT) AS exposure,
         CAST(sum(incurred_act) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS act,
         CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS pred
  FROM bucketed GROUP BY decile)""",
        _curve_sql("policy", "incurred_act", "pred, o_orderkey").replace("curve", "row_curve"),
        _curve_sql("d", "act", "pred, decile").replace("curve", "bin_curve"),
    )
    + f"""
SELECT decile, exposure, {r6('act')} AS act, {r6('pred')} AS pred,
       {r6('exposure * 100.0 / sum(exposure) OVER ()')} AS weight_pct,
       {r6(f'(SELECT {_GINI} FROM row_curve)')} AS gini_rows,
       {r6(f'(SELECT {_GINI} FROM bin_curve)')} AS gini_deciles
FROM d""",
)
def lift_2025(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=_FACTS)
    table = ev.lift(df, "exposure", "o_orderkey", variant="legacy_pct")
    rows = ev.gini(df, "incurred_act", "pred", ["o_orderkey"]).select("gini").scalar()
    bins = ev.gini(table, "act", "pred", ["decile"]).select("gini").scalar()
    return tidy(table.withColumns({"gini_rows": rows, "gini_deciles": bins}))


@query(
    "gini_rows",
    with_views(POLICY_SQL, _curve_sql("policy", "incurred_act", "pred, o_orderkey"))
    + f" SELECT CAST(max(n) AS BIGINT) AS n, {r6(_GINI)} AS gini FROM curve",
)
def gini_rows(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=("o_orderkey", "incurred_act", "pred"))
    return tidy(ev.gini(df, "incurred_act", "pred", ["o_orderkey"]))


_GAPS_SQL = """
gaps AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN incurred_act ELSE 0 END AS incurred_act,
         CASE WHEN o_orderkey % 7 <> 0 THEN pred ELSE 1000000000 END AS pred
  FROM policy)"""


def _gaps(spark, sf_dir):
    """Actuals and predictions with gaps: a missing actual counts as 0, a missing score is last."""
    df = _policy(spark, sf_dir, columns=("o_orderkey", "incurred_act", "pred"))
    act = F.when(F.col("o_orderkey") % 5 != 0, F.col("incurred_act"))
    pred = F.when(F.col("o_orderkey") % 7 != 0, F.col("pred").cast("double"))
    return df.withColumns({"incurred_act": act, "pred": pred})


@query(
    "gini_missing",
    with_views(POLICY_SQL, _GAPS_SQL, _curve_sql("gaps", "incurred_act", "pred, o_orderkey"))
    + f" SELECT CAST(max(n) AS BIGINT) AS n, {r6(_GINI)} AS gini FROM curve",
)
def gini_missing(spark, sf_dir):
    return tidy(ev.gini(_gaps(spark, sf_dir), "incurred_act", "pred", ["o_orderkey"], rows_per_range=500))


@query(
    "lorenz_missing",
    with_views(POLICY_SQL, _GAPS_SQL, _curve_sql("gaps", "incurred_act", "pred, o_orderkey"))
    + f"""
SELECT CAST(rn AS BIGINT) AS position, {r6('CAST(rn AS DOUBLE) / n')} AS population_share,
       {r6('c')} AS actual_share FROM curve
UNION ALL SELECT CAST(0 AS BIGINT), 0.0::DOUBLE, 0.0::DOUBLE""",
)
def lorenz_missing(spark, sf_dir):
    return tidy(ev.lorenz(_gaps(spark, sf_dir), "incurred_act", "pred", ["o_orderkey"], rows_per_range=500))


def _tenths(spark, sf_dir):
    """Weights in tenths and a decimal score."""
    df = _policy(spark, sf_dir, columns=_FACTS)
    return df.withColumns(
        {"tenths": F.col("exposure") * 0.1, "pred": F.col("pred").cast("decimal(18,2)")}
    )


@query(
    "lift_fractional",
    with_views(POLICY_SQL, _buckets_sql("policy", "ceil"))
    + f"""
SELECT decile, {r6("CAST(sum(exposure) AS DOUBLE) / 10.0")} AS tenths,
       {r6("CAST(sum(incurred_act) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)")} AS act,
       {r6("CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)")} AS pred
FROM bucketed GROUP BY decile""",
)
def lift_fractional(spark, sf_dir):
    out = ev.lift(_tenths(spark, sf_dir), "tenths", "o_orderkey", rows_per_range=500)
    return tidy(out.select("decile", "tenths", "act", "pred"))


@query(
    "gini_deciles",
    with_views(
        POLICY_SQL,
        _buckets_sql("policy", "ceil"),
        """
d AS (
  SELECT decile, CAST(sum(incurred_act) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS act,
         CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE) AS pred
  FROM bucketed GROUP BY decile)""",
        _curve_sql("d", "act", "pred, decile"),
    )
    + f" SELECT CAST(max(n) AS BIGINT) AS n, {r6(_GINI)} AS gini FROM curve",
)
def gini_deciles(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=_FACTS)
    table = ev.lift(df, "exposure", "o_orderkey", variant="relativity")
    return tidy(ev.gini(table, "act", "pred", ["decile"]))


@query(
    "gini_labels",
    with_views(
        """
scored AS (
  SELECT d.doc_id, CAST(quality AS BIGINT) AS quality, n_chars
  FROM labels l JOIN documents d USING (doc_id))""",
        _curve_sql("scored", "quality", "n_chars, doc_id"),
    )
    + f" SELECT CAST(max(n) AS BIGINT) AS n, {r6(_GINI)} AS gini FROM curve",
)
def gini_labels(spark, sf_dir):
    labels = b.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint"))
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return tidy(ev.gini(stage(labels.join(docs, "doc_id"), "scored"), "quality", "n_chars", ["doc_id"]))


@query(
    "lorenz_curve",
    with_views(POLICY_SQL, _curve_sql("policy", "incurred_act", "pred, o_orderkey"))
    + f"""
SELECT CAST(rn AS BIGINT) AS position, {r6('CAST(rn AS DOUBLE) / n')} AS population_share,
       {r6('c')} AS actual_share FROM curve
UNION ALL SELECT CAST(0 AS BIGINT), 0.0::DOUBLE, 0.0::DOUBLE""",
)
def lorenz_curve(spark, sf_dir):
    df = _policy(spark, sf_dir, columns=("o_orderkey", "incurred_act", "pred"))
    return tidy(ev.lorenz(df, "incurred_act", "pred", ["o_orderkey"]))


_RESIDUAL_OUT = f"""
SELECT {r6('lo')} AS lo, {r6('hi')} AS hi, CAST(w AS BIGINT) AS exposure,
       {r6('ia / dn')} AS act, {r6('ip / dn')} AS pred"""
_RESIDUAL_SUMS = """sum(exposure) AS w, CAST(sum(incurred_act) AS DOUBLE) AS ia,
         CAST(sum(incurred_pred) AS DOUBLE) AS ip, CAST(sum(denom) AS DOUBLE) AS dn"""


def _residual(spark, sf_dir, feature):
    df = b.policy(spark, sf_dir).withColumn("lvl_a", F.col("o_orderkey") % 6)
    out = ev.residual_table(df.select(feature, *_FACTS), feature, "exposure")
    return tidy(out.select("lo", "hi", "exposure", "act", "pred"))


@query(
    "residual_levels",
    with_views(
        POLICY_SQL,
        f"""
lev AS (
  SELECT CAST(o_orderkey % 6 AS DOUBLE) AS lo, CAST(o_orderkey % 6 AS DOUBLE) AS hi,
         {_RESIDUAL_SUMS}
  FROM policy GROUP BY o_orderkey % 6)""",
    )
    + _RESIDUAL_OUT
    + " FROM lev",
)
def residual_levels(spark, sf_dir):
    return _residual(spark, sf_dir, "lvl_a")


_QS = ", ".join(repr(p) + "::DOUBLE" for p in ev._even_probabilities(20))


@query(
    "residual_qcut",
    with_views(
        POLICY_SQL,
        """
lev AS (
  SELECT round_even(cont * 100.0, 0) / 100.0 AS level, sum(exposure) AS exposure,
         sum(incurred_act) AS incurred_act, sum(incurred_pred) AS incurred_pred, sum(denom) AS denom
  FROM policy GROUP BY cont)""",
        f"""
edges AS (SELECT unnest(list_distinct(quantile_cont(level, [{_QS}]))) AS edge FROM lev),
inner_edges AS (
  SELECT edge FROM edges
  WHERE edge > (SELECT min(edge) FROM edges) AND edge < (SELECT max(edge) FROM edges)),
binned AS (
  SELECT lev.*, (SELECT count(*) FROM inner_edges WHERE level > edge) AS bin FROM lev),
res AS (
  SELECT bin, min(level) AS lo, max(level) AS hi, {_RESIDUAL_SUMS}
  FROM binned GROUP BY bin)""",
    )
    + _RESIDUAL_OUT
    + " FROM res",
)
def residual_qcut(spark, sf_dir):
    return _residual(spark, sf_dir, "cont")


@query(
    "residual_all",
    with_views(
        POLICY_SQL,
        f"""
raw AS (
  SELECT 'cont' AS field, cont AS raw, sum(exposure) AS exposure, sum(incurred_act) AS incurred_act,
         sum(incurred_pred) AS incurred_pred, sum(denom) AS denom FROM policy GROUP BY cont
  UNION ALL
  SELECT 'half', floor(cont / 2), sum(exposure), sum(incurred_act), sum(incurred_pred), sum(denom)
  FROM policy GROUP BY floor(cont / 2)),
lev AS (SELECT * REPLACE (round_even(raw * 100.0, 0) / 100.0 AS raw) FROM raw),
edges AS (
  SELECT field, unnest(list_distinct(quantile_cont(raw, [{_QS}]))) AS edge FROM lev GROUP BY field),
inner_edges AS (
  SELECT field, edge FROM edges QUALIFY edge > min(edge) OVER (PARTITION BY field)
    AND edge < max(edge) OVER (PARTITION BY field)),
binned AS (
  SELECT lev.*, (SELECT count(*) FROM inner_edges e WHERE e.field = lev.field AND raw > edge) AS bin FROM lev),
res AS (SELECT field, bin, min(raw) AS lo, max(raw) AS hi, {_RESIDUAL_SUMS} FROM binned GROUP BY field, bin
  UNION ALL
  SELECT 'lvl_a', 0, CAST(o_orderkey % 6 AS DOUBLE), CAST(o_orderkey % 6 AS DOUBLE), {_RESIDUAL_SUMS}
  FROM policy GROUP BY o_orderkey % 6)""",
    )
    + _RESIDUAL_OUT.replace("SELECT", "SELECT field,", 1)
    + " FROM res",
)
def residual_all(spark, sf_dir):
    """Features with few and with many levels in one pass."""
    levels = {"lvl_a": F.col("o_orderkey") % 6, "half": F.floor(F.col("cont") / 2)}
    df = b.policy(spark, sf_dir).withColumns(levels).select("lvl_a", "half", "cont", *_FACTS)
    out = ev.residual_tables(df, ["lvl_a", "half", "cont"], "exposure")
    return tidy(out.select("field", "lo", "hi", "exposure", "act", "pred"))


@query(
    "weight_share",
    with_views(POLICY_SQL)
    + f"""
SELECT fold, CAST(sum(exposure) AS BIGINT) AS exposure,
       {r6('CAST(sum(exposure) AS DOUBLE) * 100.0 / CAST(sum(sum(exposure)) OVER () AS DOUBLE)')} AS weight_pct
FROM policy GROUP BY fold""",
)
def weight_share(spark, sf_dir):
    by_fold = b.policy(spark, sf_dir).groupBy("fold").agg(F.sum("exposure").alias("exposure"))
    return tidy(by_fold.select("fold", "exposure", ev.weight_share("exposure")))


@query(
    "prediction_facts",
    with_views(POLICY_SQL)
    + f"""
SELECT o_orderkey, {r6('incurred_act')} AS incurred_act, exposure AS denom,
       exposure * pred AS incurred_pred,
       {r6('incurred_act * offset_f')} AS incurred_act_offsetadded,
       {r6('exposure * pred * offset_f')} AS incurred_pred_offsetadded,
       {r6('exposure * offset_f')} AS denom_offsetadded
FROM policy WHERE exposure > 0 AND incurred_act >= 0""",
)
def prediction_facts(spark, sf_dir):
    valid = ev.valid_facts(b.policy(spark, sf_dir), "incurred_act", "exposure", "exposure")
    scored = valid.select("o_orderkey", "exposure", "incurred_act", "pred", "offset_f")
    facts = ev.prediction_facts(scored, "incurred_act", "exposure", "offset_f")
    return tidy(facts.drop("exposure", "pred", "offset_f"))


@query(
    "score_facts",
    with_views(POLICY_SQL)
    + f"""
SELECT fold, CAST(sum(denom) AS BIGINT) AS denom, CAST(sum(pred) AS BIGINT) AS incurred_pred,
       {r6('sum(incurred_act)')} AS incurred_act
FROM policy GROUP BY fold""",
)
def score_facts(spark, sf_dir):
    df = b.policy(spark, sf_dir)
    exposure = ev.weight_column(df.columns, "exposure")
    facts = ev.score_facts(
        df.select("fold", "pred", F.col("incurred_act").alias("pp"), exposure), "pp", exposure
    )
    return tidy(
        facts.groupBy("fold").agg(
            F.sum("denom").alias("denom"),
            F.sum("incurred_pred").alias("incurred_pred"),
            F.sum("incurred_act").alias("incurred_act"),
        )
    )


@query(
    "mae_rmse",
    with_views(POLICY_SQL)
    + f"""
SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split,
       round_even(avg(abs(pred - CAST(incurred_act AS DOUBLE))) * 10000.0, 0) / 10000.0 AS mae,
       round_even(sqrt(avg((pred - CAST(incurred_act AS DOUBLE)) * (pred - CAST(incurred_act AS DOUBLE)))) * 10000.0, 0)
         / 10000.0 AS rmse,
       count(*) AS size
FROM policy GROUP BY 1""",
)
def mae_rmse(spark, sf_dir):
    df = b.policy(spark, sf_dir).withColumn("split", F.when(F.col("train"), "train").otherwise("test"))
    return tidy(ev.error_metrics(df, "incurred_act", "pred", "split"), 4)


@query(
    "run_metrics",
    with_views(POLICY_SQL)
    + """
SELECT round_even(avg(abs(e)) FILTER (train) * 10000.0, 0) / 10000.0 AS train_mae,
       round_even(avg(abs(e)) FILTER (NOT train) * 10000.0, 0) / 10000.0 AS test_mae,
       round_even(sqrt(avg(e * e) FILTER (train)) * 10000.0, 0) / 10000.0 AS train_rmse,
       round_even(sqrt(avg(e * e) FILTER (NOT train)) * 10000.0, 0) / 10000.0 AS test_rmse,
       count(*) FILTER (train) AS train_size, count(*) FILTER (NOT train) AS test_size,
       3 AS n_features
FROM (SELECT train, pred - CAST(incurred_act AS DOUBLE) AS e FROM policy)""",
)
def run_metrics(spark, sf_dir):
    out = ev.run_metrics(b.policy(spark, sf_dir), "incurred_act", "pred", F.col("train"), 3)
    return tidy(out, 4)


@query(
    "global_ratio",
    with_views(POLICY_SQL)
    + f"""
SELECT {r6('CAST(sum(incurred_act) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)')} AS overall_act,
       {r6('CAST(sum(incurred_pred) AS DOUBLE) / CAST(sum(denom) AS DOUBLE)')} AS overall_pred
FROM policy""",
)
def global_ratio(spark, sf_dir):
    return tidy(ev.overall_levels(b.policy(spark, sf_dir)))
