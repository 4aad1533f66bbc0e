"""Contribution tables: importance, ranges, percentiles and summaries over all features at once.

A contribution frame has a row key, one column per feature, and a weight. Totals per feature are
one wide aggregate. Tables per feature level unpivot the features inside the scan and sum weights
map-side before the only shuffle, so a level shared by many rows arrives as its distinct rounded
contributions. That also bounds the windows below: a (field, value) group holds at most one row
per rounded contribution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from liftworks.functions import missing_to_null, round_digits, round_step
from liftworks.operators.assemble import anti_filter
from liftworks.operators.ordered import ROWS_PER_RANGE, fill_from_below, running_totals
from liftworks.sources import stage

_LEVEL = ("field", "val")


def _doubles(df: DataFrame, column: str) -> Column:
    return missing_to_null(F.col(column), df.schema[column].dataType).cast("double")


# --- totals per feature -----------------------------------------------------------------------


def contrib_totals(contrib: DataFrame, features: Sequence[str], weight: str) -> DataFrame:
    """``(field, total_shap)``: weighted absolute contributions."""
    one = contrib.agg(
        *[F.sum(F.abs(F.coalesce(_doubles(contrib, c), F.lit(0.0))) * F.col(weight)).alias(c) for c in features]
    )
    return one.unpivot([], list(features), "field", "total_shap")


def with_shares(totals: DataFrame) -> DataFrame:
    """Cumulative total, share and cumulative share, by falling total; one row per feature."""
    everything = Window.partitionBy()
    falling = everything.orderBy(F.desc("total_shap"), "field").rowsBetween(
        Window.unboundedPreceding, 0
    )
    used = totals.filter(F.col("total_shap") > 0)
    used = used.withColumn("cum_shap_abs", F.sum("total_shap").over(falling))
    return used.withColumns(
        {
            "shap_abs_pct": F.try_divide(F.col("total_shap"), F.sum("total_shap").over(everything)),
            "cum_shap_abs_pct": F.try_divide(
                F.col("cum_shap_abs"), F.max("cum_shap_abs").over(everything)
            ),
        }
    )


def contrib_aggregate(contrib: DataFrame, features: Sequence[str], weight: str) -> DataFrame:
    """Used features with shares, largest first."""
    totals = contrib_totals(contrib, features, weight)
    return with_shares(totals).orderBy(F.desc("total_shap"), "field")


def contrib_aggregate_numeric(
    contrib: DataFrame,
    features: Sequence[str],
    weight: str,
    settings: DataFrame,
    excluded: DataFrame,
) -> DataFrame:
    """The same for non-boolean features of a settings table; excluded ones drop out last."""
    types = settings.select("field", "dtype").filter(F.col("dtype") != "bool")
    totals = contrib_totals(contrib, features, weight).join(F.broadcast(types), "field")
    shares = with_shares(totals).drop("cum_shap_abs")
    return anti_filter(shares, excluded, "field").orderBy(F.desc("total_shap"), "field")


def importance(contrib: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(field, importance, pct_importance)``: mean absolute contribution and its share."""
    means = contrib.agg(*[F.avg(F.abs(_doubles(contrib, c))).alias(c) for c in features])
    long = means.unpivot([], list(features), "field", "importance")
    share = F.try_divide(F.col("importance") * 100.0, F.sum("importance").over(Window.partitionBy()))
    return long.withColumn("pct_importance", share)  # one row per feature


def top_features(table: DataFrame, by: str, n: int) -> DataFrame:
    return table.orderBy(F.desc(by), "field").limit(n)


def with_remainder(table: DataFrame, by: str, n: int) -> DataFrame:
    """Top ``n`` features, and the sum of the others as one row if it is positive."""
    falling = Window.partitionBy().orderBy(F.desc(by), "field")
    everything = Window.partitionBy()
    ranked = table.select(
        "field", by, F.row_number().over(falling).alias("rank"), F.count("*").over(everything).alias("n")
    )
    # Fixed value: name of the remainder row
    label = F.concat(F.lit("Sum of "), (F.col("n") - n).cast("string"), F.lit(" other features"))
    folded = ranked.select(
        F.when(F.col("rank") <= n, F.col("field")).otherwise(label).alias("feature"),
        F.least(F.col("rank"), F.lit(n + 1)).alias("rank"),
        by,
    )
    sums = folded.groupBy("rank", "feature").agg(F.sum(by).alias(by))
    return sums.filter((F.col("rank") <= n) | (F.col(by) > 0)).orderBy("rank")


# --- tables per feature level -----------------------------------------------------------------


def long_contributions(
    contrib: DataFrame, data: DataFrame, features: Sequence[str], key: str, weight: str
) -> DataFrame:
    """Rows ``(field, val, contrib, weight)`` of all features, data and contributions by key."""
    values = data.select(key, *[_doubles(data, c).alias(f"__v_{c}") for c in features])
    effects = contrib.select(
        key, F.col(weight).alias("weight"), *[_doubles(contrib, c).alias(f"__c_{c}") for c in features]
    )
    rows = [
        F.struct(
            F.lit(c).alias("field"),
            F.col(f"__v_{c}").alias("val"),
            F.col(f"__c_{c}").alias("contrib"),
            F.col("weight"),
        )
        for c in features
    ]
    return values.join(effects, key).select(F.inline(F.array(*rows)))


def used_only(long: DataFrame) -> DataFrame:
    return long.filter(F.coalesce(F.col("contrib"), F.lit(0.0)) != 0)


def _stepped(long: DataFrame, step: float | Mapping[str, float]) -> Column:
    """Feature values rounded to a step, one for all fields or one per field."""
    if not isinstance(step, Mapping):
        return round_step(F.col("val"), step)
    out = F.col("val")
    for name, width in step.items():
        out = F.when(F.col("field") == name, round_step(F.col("val"), width)).otherwise(out)
    return out


def contrib_value_table(long: DataFrame, digits: int = 5) -> DataFrame:
    """Weight per field, value and rounded contribution; missing values drop out."""
    rounded = long.dropna(subset=["val", "contrib"]).select(
        "field", "val", round_digits(F.col("contrib"), digits).alias("shap"), "weight"
    )
    return rounded.groupBy("field", "val", "shap").agg(F.sum("weight").alias("weight"))


def contrib_range(
    long: DataFrame,
    digits: int = 3,
    step: float | Mapping[str, float] = 1,
    only_used: bool = False,
) -> DataFrame:
    """Mean contribution per field, value and percentile (0..100) of the weight in that value."""
    rows = long.select(
        "field",
        _stepped(long, step).alias("val"),
        round_digits(F.col("contrib"), digits).alias("contrib"),
        "weight",
    )
    if only_used:
        rows = used_only(rows)
    levels = (
        rows.dropna(subset=["val", "contrib"])
        .groupBy("field", "val", "contrib")
        .agg(F.sum("weight").alias("weight"))
    )
    group = Window.partitionBy(*_LEVEL)
    upto = group.orderBy("contrib").rowsBetween(Window.unboundedPreceding, 0)
    share = F.try_divide(
        F.sum("weight").over(upto).cast("double"), F.sum("weight").over(group).cast("double")
    )
    # the percentile is cut, not rounded: 0.29 * 100 is 28.999...
    placed = levels.withColumn("ntile", (round_digits(share, 2) * 100.0).cast("int"))
    return (
        placed.filter(F.col("ntile").isNotNull())
        .groupBy(*_LEVEL, "ntile")
        .agg(
            F.try_divide(F.sum(F.col("contrib") * F.col("weight")), F.sum("weight").cast("double")).alias(
                "shap"
            )
        )
    )


def fill_range(table: DataFrame, ntiles: tuple[int, int] = (0, 100)) -> DataFrame:
    """Every percentile 0..100 per level: the next lower known one, below the first the minimum."""
    grid = table.select(*_LEVEL).distinct().withColumn(
        "ntile", F.explode(F.sequence(F.lit(0), F.lit(100)))
    )
    filled = fill_from_below(grid, table, _LEVEL, "ntile", "shap")
    return filled.filter(F.col("ntile").between(*ntiles))


def contrib_weight_dist(
    long: DataFrame, digits: int = 3, step: float | Mapping[str, float] = 1
) -> DataFrame:
    """Weight and used weight per field and value; used weight is null where nothing is used."""
    rows = long.select(
        "field",
        _stepped(long, step).alias("val"),
        round_digits(F.col("contrib"), digits).alias("contrib"),
        "weight",
    ).dropna(subset=["val"])
    used = F.when(F.coalesce(F.col("contrib"), F.lit(0.0)) != 0, F.col("weight"))
    sums = rows.groupBy(*_LEVEL).agg(F.sum("weight").alias("weight"), F.sum(used).alias("used_weight"))
    return sums.withColumn("val", round_digits(F.col("val"), 4))


def _with_used_share(values: DataFrame) -> DataFrame:
    """Cumulative weight share of the used contributions of a level; null where not used."""
    group = Window.partitionBy(*_LEVEL)
    upto = group.orderBy("shap").rowsBetween(Window.unboundedPreceding, 0)
    used_weight = F.when(F.col("shap") != 0, F.col("weight"))
    running, total = F.sum(used_weight).over(upto), F.sum(used_weight).over(group)
    share = F.try_divide(running.cast("double"), total.cast("double"))
    return values.withColumn("share", F.when(F.col("shap") != 0, share))


def _percentile(p: int, digits: int) -> tuple[list[Column], Column]:
    """Aggregates that keep the nearest shares around a target, and the result from them."""
    gap = F.col("share") - F.lit(p / 100)
    near = F.struct(gap.alias("gap"), (-F.col("shap")).alias("minus"))
    kept = [
        F.max(F.when(gap < 0, near)).alias(f"below_{p}"),
        F.min(F.when(gap == 0, F.col("shap"))).alias(f"at_low_{p}"),
        F.max(F.when(gap == 0, F.col("shap"))).alias(f"at_high_{p}"),
        F.min(F.when(gap > 0, near)).alias(f"above_{p}"),
    ]
    below, above = F.col(f"below_{p}"), F.col(f"above_{p}")
    at_gap = F.when(F.col(f"at_low_{p}").isNotNull(), F.lit(0.0))
    least = F.coalesce(below["gap"], at_gap, above["gap"])
    most = F.coalesce(above["gap"], at_gap, below["gap"])
    low = F.coalesce(-below["minus"], F.col(f"at_low_{p}"), -above["minus"])
    high = F.coalesce(-above["minus"], F.col(f"at_high_{p}"), -below["minus"])
    space = most - least
    mixed = F.try_divide(-least, space) * low + F.try_divide(most, space) * high
    value = F.when((space == 0) & (most > 0), high).otherwise(round_digits(mixed, digits))
    return kept, value.alias(f"shap_p{p}")


def contrib_percentiles(
    values: DataFrame, percentiles: Sequence[int] = (0, 5, 95, 100), digits: int = 5
) -> DataFrame:
    """Contribution percentiles per field and value, over the levels that are used.

    For a target share the nearest cumulative shares below, at and above it are kept. The result
    weighs the least and largest kept contribution by the distance of the lower and the upper
    share; with no lower share it is the contribution itself. For the 100th percentile this is the
    second largest contribution, and missing for a single level.
    """
    parts = [_percentile(p, digits) for p in percentiles]
    used = _with_used_share(values.filter(F.col("shap") != 0))
    kept = used.groupBy(*_LEVEL).agg(*[k for keep, _ in parts for k in keep])
    return kept.select(*_LEVEL, *[value for _, value in parts])


def contrib_summary(
    values: DataFrame, percentiles: Sequence[int] = (0, 5, 95, 100), digits: int = 5
) -> DataFrame:
    """Per field and value: share of the field's weight, used share, percentiles and mean.

    Values whose contributions are all zero drop out. Window and sums share one shuffle.
    """
    used = F.col("shap") != 0
    parts = [_percentile(p, digits) for p in percentiles]
    sums = (
        _with_used_share(values)
        .groupBy(*_LEVEL)
        .agg(
            F.sum("weight").alias("weight"),
            F.sum(F.when(used, F.col("weight"))).alias("weight_used"),
            F.sum(F.when(used, F.col("shap") * F.col("weight"))).alias("sp"),
            *[k for keep, _ in parts for k in keep],
        )
        .filter(F.col("weight_used").isNotNull())
    )
    totals = values.groupBy("field").agg(F.sum("weight").alias("field_weight"))

    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))

    return sums.join(F.broadcast(totals), "field").select(  # one row per feature
        *_LEVEL,
        share("weight", "field_weight").alias("pct_weight"),
        share("weight_used", "weight").alias("pct_used"),
        share("sp", "weight_used").alias("shap_mean"),
        *[value for _, value in parts],
    )


def contrib_summary_all(
    values: DataFrame, mono: DataFrame | None = None, excluded: DataFrame | None = None, digits: int = 5
) -> DataFrame:
    """Summary of all fields with their total effect and monotone direction, largest effect first."""
    table = stage(contrib_summary(values, digits=digits), "summary")  # read twice
    effect = F.abs(F.col("pct_weight") * F.col("pct_used") * F.col("shap_mean"))
    fields = table.groupBy("field").agg(
        F.sum(effect).alias("field_tot_wtd_shap_abs"), F.max("pct_used").alias("most_used")
    )
    fields = fields.filter(F.col("most_used") > 0).drop("most_used")
    if mono is not None:
        fields = fields.join(mono.select("field", "mono"), "field", "left")
    if excluded is not None:
        fields = anti_filter(fields, excluded, "field")
    return table.join(F.broadcast(fields), "field").orderBy(  # one row per feature
        F.desc("field_tot_wtd_shap_abs"), F.desc("field"), F.desc("val")
    )


def feature_bounds(
    long: DataFrame, lo: float = 0.01, hi: float = 0.99, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``(field, low, high)``: weighted first and last percentile of each feature's values."""
    weights = stage(
        long.dropna(subset=["val"]).groupBy(*_LEVEL).agg(F.sum("weight").alias("weight")), "weights"
    )
    totals = weights.groupBy("field").agg(F.sum("weight").alias("total"))
    running = running_totals(
        weights, ["val"], {"running": F.col("weight")}, by=["field"], rows_per_range=rows_per_range
    )
    share = round_digits(
        F.try_divide(F.col("running").cast("double"), F.col("total").cast("double")), 3
    )
    val = F.col("val")
    return (
        running.join(F.broadcast(totals), "field")  # one row per feature
        .groupBy("field")
        .agg(
            F.coalesce(F.max(F.when(share <= lo, val)), F.min(val)).alias("low"),
            F.min(F.when(share >= hi, val)).alias("high"),
        )
    )
