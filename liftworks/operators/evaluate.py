"""Model evaluation: prediction facts, lift tables, Gini and Lorenz, residuals, error metrics.

Lift tables find the few rows at which the bucket changes (``ordered.crossings``); the bucket of
every other row is then a comparison with at most ``bins`` constants, and the table itself a
map-side aggregate. No pass shuffles the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from liftworks.functions import is_missing, missing_to_null, per_hundred, round_digits
from liftworks.operators.ordered import (
    ROWS_PER_RANGE,
    ceil_rule,
    floor_rule,
    running_totals,
    bucket_sums,
    zero_if_missing,
)
from liftworks.sources import release, stage

_LOSSES = ("incurred_act", "incurred_pred")

# --- checks and filters -----------------------------------------------------------------------


def violations(
    df: DataFrame, weight: str, bins: int, base: str = "pred", denom: str | None = "denom"
) -> list[str]:
    """All preconditions of the relativity lift tables that do not hold, in one aggregate."""
    needed = ["pred", *_LOSSES, weight, *([denom] if denom else [])]
    out = [f"column {c} is absent" for c in needed if c not in df.columns]
    if bins < 2:
        out.append("a lift table takes two buckets or more")
    if base not in ("pred", "act"):
        out.append(f"relativities are to 'pred' or 'act', not to {base!r}")
    if weight not in df.columns:
        return out
    tests = [F.sum(weight).alias("weights"), F.count_if(F.col(weight) < 0).alias("negative")]
    if denom in df.columns:
        tests.append(F.count_if(F.col(denom) <= 0).alias("empty"))
    seen = df.agg(*tests).first().asDict()
    if seen.get("empty"):
        out.append(f"{denom} is not positive in {seen['empty']} rows")
    if seen["negative"]:
        out.append(f"{weight} is negative in {seen['negative']} rows")
    if not (seen["weights"] or 0) > 0:
        out.append(f"{weight} adds up to nothing")
    return out


def check_facts(df: DataFrame, *args, **options) -> None:
    """Raise with every violated precondition."""
    found = violations(df, *args, **options)
    if found:
        raise ValueError("; ".join(found))


def valid_facts(df: DataFrame, numerator: str, denominator: str, weight: str) -> DataFrame:
    return df.filter(
        (F.col(weight) > 0) & (F.col(denominator) > 0) & (F.col(numerator) >= 0)
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which none of ``columns`` is missing."""
    return df.dropna(subset=list(columns))


def excluded_loss_share(df: DataFrame, premium: str, weight: str | None = None) -> DataFrame:
    """What dropping rows without positive premium would lose: rows and shares of both losses.

    Rows in which the prediction, a loss, the premium or the weight is missing count nowhere.
    """
    bad = F.col(premium) <= 0
    part = [F.sum(F.when(bad, F.col(c)).otherwise(0)).alias(c) for c in _LOSSES]
    whole = [F.sum(c).alias(f"all_{c}") for c in _LOSSES]
    known = ["pred", *_LOSSES, premium, *([weight] if weight else [])]
    sums = drop_incomplete(df, known).agg(
        F.count(F.when(bad, 1)).alias("dropped_rows"), *part, *whole
    )
    return sums.select(
        "dropped_rows",
        *[
            F.try_divide(F.col(c).cast("double"), F.col(f"all_{c}").cast("double")).alias(name)
            for c, name in zip(_LOSSES, ("actual_share", "predicted_share"))
        ],
    )


# --- prediction facts -------------------------------------------------------------------------


def weight_column(columns: Sequence[str], configured: str | None, strict: bool = False) -> str | None:
    """Exposure column to weight by: the configured one, ``ee``, ``ee_imps``, or none (weight 1)."""
    if strict and configured and configured not in columns:
        raise ValueError(f"Exposure column {configured} is not in the data")
    return next((c for c in (configured, "ee", "ee_imps") if c and c in columns), None)


def rate_target(df: DataFrame, numerator: str, denominator: str, name: str = "target") -> DataFrame:
    num = F.coalesce(F.col(numerator).cast("double"), F.lit(0.0))
    return df.withColumn(name, F.try_divide(num, F.col(denominator).cast("double")))


def prediction_facts(
    df: DataFrame, numerator: str, denominator: str, offset: str | None = None
) -> DataFrame:
    """Actual and predicted loss of rate predictions, also multiplied by the offset if given."""
    facts = {
        "incurred_act": F.col(numerator),
        "denom": F.col(denominator),
        "incurred_pred": F.col(denominator) * F.col("pred"),
    }
    if offset:
        facts |= {f"{n}_offsetadded": c * F.col(offset) for n, c in list(facts.items())}
    return df.withColumns(facts)


def score_facts(df: DataFrame, target: str, exposure: str | None) -> DataFrame:
    """Facts of the staged pipeline: the prediction itself is the predicted loss."""
    unit = F.lit(1)
    return df.withColumns(
        {
            "incurred_act": F.col(target),
            "incurred_pred": F.col("pred"),
            "denom": F.col(exposure) if exposure else unit,
            "weight": F.col(exposure) if exposure else unit,
        }
    )


# --- lift tables ------------------------------------------------------------------------------


def _ratio(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def _missing_last(df: DataFrame, pred: str, key: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Order by prediction, missing ones (null or NaN) last, then by key."""
    absent = is_missing(F.col(pred), df.schema[pred].dataType).cast("int")
    return df.withColumn("__missing", absent), ["__missing", pred, *[k for k in key if k != pred]]


def _decile_sums(
    df: DataFrame, weight: str, key: str, bins: int, facts: Sequence[str], rule, rows_per_range: int
) -> DataFrame:
    df, order = _missing_last(df, "pred", [key])
    score = F.when(F.col("__missing") == 1, float("inf")).otherwise(F.col("pred").cast("double"))
    sums = list(dict.fromkeys([weight, *facts]))
    found = bucket_sums(df, order, score, F.col(weight), bins, sums, rule, rows_per_range)
    return found.withColumnRenamed("bucket", "decile")


def lift(
    df: DataFrame,
    weight: str,
    key: str,
    bins: int = 10,
    variant: str = "fast",
    base: str = "pred",
    premium: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Actual and predicted loss per weighted bucket of the prediction.

    ``variant``: ``fast`` divides both relativities by the overall prediction; ``relativity`` and
    ``premium`` divide the actual by the overall actual and the prediction by ``base``;
    ``legacy``, ``legacy_pct`` and ``offset`` use the older bucket rule and give levels only.
    Rows with equal predictions are ordered by ``key``, rows without one come last.
    """
    if variant not in ("fast", "relativity", "premium", "legacy", "legacy_pct", "offset"):
        raise ValueError(f"unknown lift variant {variant}")
    facts, denom, rule = ["incurred_act", "incurred_pred", "denom"], "denom", ceil_rule
    if variant in ("legacy", "legacy_pct", "offset"):
        rule = floor_rule
    if variant == "offset":
        facts = [f"{f}_offsetadded" for f in facts]
        denom = "denom_offsetadded"
    if variant == "premium":
        if not premium:
            raise ValueError("variant 'premium' needs a premium column")
        facts, denom = ["incurred_act", "incurred_pred", premium], premium
        check_facts(df, weight, bins, base, None)  # before rows without premium go
        if premium not in df.columns:
            raise ValueError(f"column {premium} is absent")
        df = drop_incomplete(df, ["pred", *facts, weight]).filter(F.col(premium) > 0)
    if variant == "relativity":
        check_facts(df, weight, bins, base)
    act, pred = facts[0], facts[1]

    sums = _decile_sums(df, weight, key, bins, facts, rule, rows_per_range)
    overall = Window.partitionBy()  # over at most ``bins`` rows
    levels = sums.withColumns({"act": _ratio(act, denom), "pred": _ratio(pred, denom)})
    if variant in ("legacy", "offset"):
        return levels.select("decile", weight, "act", "pred")
    if variant == "legacy_pct":
        return levels.select("decile", weight, weight_share(weight), "act", "pred")
    all_act = _ratio(F.sum(act).over(overall), F.sum(denom).over(overall))
    all_pred = _ratio(F.sum(pred).over(overall), F.sum(denom).over(overall))
    act_base, pred_base = {
        "fast": (all_pred, all_pred),
    }.get(variant, (all_act, all_pred if base == "pred" else all_act))
    return levels.withColumns(
        {
            "act_rel": F.try_divide(F.col("act"), act_base),
            "pred_rel": F.try_divide(F.col("pred"), pred_base),
        }
    ).select(
        "decile", *dict.fromkeys([weight, *facts]), "act", "pred", "act_rel", "pred_rel",
        weight_share(weight),
    )


def overall_levels(df: DataFrame, denom: str = "denom") -> DataFrame:
    """Actual and predicted level of the whole portfolio, one row."""
    return df.agg(
        _ratio(F.sum("incurred_act"), F.sum(denom)).alias("overall_act"),
        _ratio(F.sum("incurred_pred"), F.sum(denom)).alias("overall_pred"),
    )


def weight_share(weight: str) -> Column:
    """Weight of a bucket as a percentage of all buckets."""
    total = F.sum(F.col(weight)).over(Window.partitionBy())
    return per_hundred(F.col(weight).cast("double"), total.cast("double")).alias("weight_pct")


# --- Gini and Lorenz --------------------------------------------------------------------------


def _ranked(df: DataFrame, actual: str, pred: str, key: Sequence[str], rows_per_range: int) -> DataFrame:
    """Rank and running actual; a missing actual counts as 0, a missing prediction ranks last."""
    df = df.select(actual, pred, *[k for k in key if k not in (actual, pred)])
    df, order = _missing_last(df.withColumn(actual, zero_if_missing(df, actual)), pred, key)
    sums = {"rank": F.lit(1).cast("bigint"), "running": F.col(actual)}
    return running_totals(df, order, sums, rows_per_range=rows_per_range)


def gini(
    df: DataFrame, actual: str, pred: str, key: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One minus twice the area under the ascending Lorenz curve, by trapezoids from 1/n to 1.

    One row ``(n, gini)``; unweighted, and without the origin as a curve point.
    """
    ranked = _ranked(df, actual, pred, key, rows_per_range)
    parts = ranked.agg(
        F.max("rank").alias("n"),
        F.sum(F.col("running").cast("double")).alias("area"),
        F.max(F.when(F.col("rank") == 1, F.col("running"))).cast("double").alias("first"),
        F.sum(actual).cast("double").alias("total"),
    )
    # sum over i>=2 of c(i) + c(i-1) is twice the sum of all c, less the first and the last
    twice = 2.0 * F.col("area") - F.col("first") - F.col("total")
    return parts.select("n", (1.0 - F.try_divide(twice, F.col("total") * F.col("n"))).alias("gini"))


def lorenz(
    df: DataFrame, actual: str, pred: str, key: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Curve points ``(position, population_share, actual_share)``, the origin at position 0."""
    ranked = _ranked(df, actual, pred, key, rows_per_range)
    whole = df.agg(
        F.count(F.lit(1)).cast("double").alias("__n"),
        F.sum(zero_if_missing(df, actual)).cast("double").alias("__total"),
    )
    points = ranked.crossJoin(F.broadcast(whole)).select(  # one row of totals
        F.col("rank").alias("position"),
        F.try_divide(F.col("rank").cast("double"), "__n").alias("population_share"),
        F.try_divide(F.col("running").cast("double"), "__total").alias("actual_share"),
    )
    origin = df.sparkSession.createDataFrame([(0, 0.0, 0.0)], points.schema)
    return points.unionByName(origin)


# --- residuals and errors ---------------------------------------------------------------------


def residual_tables(
    df: DataFrame,
    features: Sequence[str],
    weight: str,
    digits: int = 2,
    max_levels: int = 50,
    q: int = 20,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Actual and predicted level per feature level, or per quantile bin of the level table.

    Bins apply when a feature has more than ``max_levels`` distinct raw levels: ``q`` quantiles over
    the rounded levels, right-closed, equal edges merged. ``lo`` and ``hi`` bound the levels of a
    row; without bins both are the level. The rows are read once for all features; binning works
    on the level table.
    """
    facts = list(dict.fromkeys([weight, "incurred_act", "incurred_pred", "denom"]))
    pairs = [
        F.struct(
            F.lit(c).alias("field"),
            missing_to_null(F.col(c), df.schema[c].dataType).cast("double").alias("raw"),
        )
        for c in features
    ]
    levels = stage(
        df.select(F.inline(F.array(*pairs)), *facts)
        .filter(F.col("raw").isNotNull())
        .groupBy("field", "raw")
        .agg(*[F.sum(f).alias(f) for f in facts])
        .select("field", round_digits(F.col("raw"), digits).alias("level"), *facts),
        "levels",
    )
    edges = _bin_edges(levels, max_levels, q, rows_per_range)
    bin_id = F.lit(None).cast("int")
    for field, cuts in edges.items():
        place = F.lit(1)
        for i, edge in enumerate(cuts[1:-1], 1):
            place = F.when(F.col("level") > edge, i + 1).otherwise(place)
        bin_id = F.when(F.col("field") == field, place).otherwise(bin_id)
    placed = levels.withColumn("bin", bin_id)
    single = placed.filter(F.col("bin").isNull()).select(
        "field", F.col("level").alias("lo"), F.col("level").alias("hi"), *facts
    )
    binned = (
        placed.filter(F.col("bin").isNotNull())
        .groupBy("field", "bin")
        .agg(
            F.min("level").alias("lo"),
            F.max("level").alias("hi"),
            *[F.sum(f).alias(f) for f in facts],
        )
        .drop("bin")
    )
    return single.unionByName(binned).withColumns(
        {"act": _ratio("incurred_act", "denom"), "pred": _ratio("incurred_pred", "denom")}
    )


def _bin_edges(levels: DataFrame, max_levels: int, q: int, rows_per_range: int) -> dict[str, list[float]]:
    """Distinct quantile edges of the rounded levels of every feature with more than ``max_levels``
    raw levels, linearly interpolated. One running total finds the wanted ranks of all features."""
    sizes = levels.groupBy("field").count().collect()  # one row per feature
    spots = {
        r["field"]: [(r["count"] - 1) * p for p in _even_probabilities(q)]
        for r in sizes
        if r["count"] > max_levels
    }
    if not spots:
        return {}
    wanted = sorted({(f, r + 1) for f, s in spots.items() for x in s for r in (math.floor(x), math.ceil(x))})
    ranks = levels.sparkSession.createDataFrame(wanted, "field string, rank long")
    counts = levels.groupBy("field", "level").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(F.broadcast(ranks.select("field").distinct()), "field", "left_semi")
    upto = stage(
        running_totals(counts, ["level"], {"upto": F.col("n")}, ["field"], rows_per_range), "level_ranks"
    )
    # at most 2 * (q + 1) ranks of a feature
    hits = upto.alias("u").join(
        F.broadcast(ranks).alias("r"),
        (F.col("u.field") == F.col("r.field"))
        & (F.col("r.rank") <= F.col("u.upto"))
        & (F.col("r.rank") > F.col("u.upto") - F.col("u.n")),
    )
    at = {(r["field"], r["rank"]): r["level"] for r in hits.select("r.field", "r.rank", "u.level").collect()}
    release(upto)

    def value(field: str, spot: float) -> float:
        low, high = at[(field, math.floor(spot) + 1)], at[(field, math.ceil(spot) + 1)]
        return low + (high - low) * (spot - math.floor(spot))

    return {f: sorted({value(f, x) for x in s}) for f, s in spots.items()}


def residual_table(df: DataFrame, feature: str, weight: str, **options) -> DataFrame:
    """``residual_tables`` of one feature."""
    return residual_tables(df, [feature], weight, **options).drop("field")


def _even_probabilities(q: int) -> list[float]:
    step = 1.0 / q
    return [i * step for i in range(q)] + [1.0]


def error_metrics(df: DataFrame, label: str, pred: str, split: str) -> DataFrame:
    """MAE, RMSE and row count per split."""
    error = F.col(pred).cast("double") - F.col(label).cast("double")
    return df.groupBy(split).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.lit(1)).alias("size"),
    )


def run_metrics(df: DataFrame, label: str, pred: str, is_train: Column, n_features: int) -> DataFrame:
    """One metrics row of a model run: errors and sizes of both splits, number of features."""
    error = F.col(pred).cast("double") - F.col(label).cast("double")
    picks = {"train": is_train, "test": ~is_train}
    return df.agg(
        *[F.avg(F.when(p, F.abs(error))).alias(f"{n}_mae") for n, p in picks.items()],
        *[F.sqrt(F.avg(F.when(p, error * error))).alias(f"{n}_rmse") for n, p in picks.items()],
        *[F.count(F.when(p, 1)).alias(f"{n}_size") for n, p in picks.items()],
    ).withColumn("n_features", F.lit(n_features))
