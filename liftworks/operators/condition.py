"""Conditioning: derivations, coercion, fills, caps, clips, rounding, blanking, profiles.

Everything that touches many columns is one ``select`` or one ``agg``, never a loop of
``withColumn`` or a job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from liftworks.functions import clip, is_missing, missing_to_null, round_digits, to_number
from liftworks.operators.catalog import boolean_columns, numeric_columns, text_columns
from liftworks.operators.ordered import quantiles

# Numeric columns that arrive as text.
NUMERIC_TEXT_COLUMNS = (
    "pol_tenure_cal", "owh_loo_years_cal", "owh_loo_days_raw",
    "owt_number_of_titling_transactions_raw",
    "model_year_raw", "dml_year_raw",
    "cef_ann_mi_grp_raw", "veh_count_raw", "veh_count_imps", "driver_count_raw",
    "driver_count_imps", "pol_veh_driver_ratio_cal",
    "vc_cylinders_raw", "vc_displacement_raw", "vc_engine_valves_raw", "vc_torque_raw",
    "DrvAge_raw", "DrvAge_imps",
    "NumMinAcc_raw", "NumMinAcc_imps", "NumMajinAcc_raw", "NumMajinAcc_imps",
    "NumSpdViol_raw", "NumSpdViol_imps", "NumMinViol_raw", "NumMinViol_imps",
    "NumMajViol_raw", "NumMajViol_imps",
    "late_payments_raw", "late_payments_imps",
)


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place, in a single projection."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def has_value(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_missing(F.col(column), df.schema[column].dataType))


# --- derivations ------------------------------------------------------------------------------


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def keep_selected(df: DataFrame, passthrough: Sequence[str], selected: Sequence[str]) -> DataFrame:
    """Pass-through columns, then selected features, as far as they exist."""
    return df.select(*[c for c in dict.fromkeys([*passthrough, *selected]) if c in df.columns])


def product(*columns: str) -> Column:
    out = F.col(columns[0])
    for c in columns[1:]:
        out = out * F.col(c)
    return out


def derive_offset(
    df: DataFrame, factors: Sequence[str], incurred: str, offset: str, capped: str = "incurred_act_capped"
) -> DataFrame:
    """Composite offset, and the capped loss brought back to the unadjusted scale with it."""
    return df.withColumns(
        {offset: product(*factors), capped: F.col(incurred) * product(*factors)}
    )


def constant_columns(df: DataFrame, columns: Sequence[str], value: int = 0) -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in columns})


def fact_aliases(df: DataFrame, weight: str, num: str, denom: str, offset: str) -> DataFrame:
    names = {"weight": weight, "num": num, "denom": denom, "offset": offset}
    return df.withColumns({n: F.col(c) for n, c in names.items()})


# --- values -----------------------------------------------------------------------------------


def cap_target(
    df: DataFrame, target: str, ceiling: float | None, applies_to: Sequence[str]
) -> DataFrame:
    """Upper bound on the target as float, only for targets the ceiling applies to."""
    value = F.col(target).cast("float")
    if ceiling is not None and target in applies_to:
        value = clip(value, None, ceiling).cast("float")
    return _replace(df, {target: value})


def cap_report(df: DataFrame, target: str, ceiling: float) -> DataFrame:
    """Rows above the ceiling, and their percentage."""
    value = F.col(target).cast("float")
    above = F.count(F.when((value > ceiling) & ~F.isnan(value), 1))
    return df.agg(
        above.alias("capped_rows"),
        F.try_divide(above * 100.0, F.count(F.lit(1))).alias("capped_pct"),
    )


def clip_columns(df: DataFrame, rules: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Bound each listed column that exists."""
    return _replace(df, {c: clip(F.col(c), lo, hi) for c, (lo, hi) in rules.items() if c in df.columns})


def clip_rules(rules: DataFrame, name: str = "feature_name", low: str = "min", high: str = "max"):
    """Clipping table as parameters; rows without a lower bound are no rules."""
    picked = rules.select(
        name, F.col(low).try_cast("double").alias("low"), F.col(high).try_cast("double").alias("high")
    ).filter(F.col("low").isNotNull())
    return {r[name]: (r["low"], r["high"]) for r in picked.collect()}  # a hand-written sheet


def round_columns(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    return _replace(df, {c: round_digits(F.col(c), digits) for c in columns if c in df.columns})


def bool_to_int(df: DataFrame, keep: Sequence[str] = ("train",)) -> DataFrame:
    """All boolean columns but ``keep`` to 0/1; missing is 0."""
    flags = boolean_columns(df, keep)
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(False)).cast("int") for c in flags})


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_TEXT_COLUMNS) -> DataFrame:
    """Text columns of the list to double, unparseable to null."""
    texts = set(text_columns(df))
    return _replace(df, {c: to_number(F.col(c)) for c in columns if c in texts})


def apply_conversions(df: DataFrame, conversions: DataFrame) -> DataFrame:
    """Coerce what a conversion table ``(column_name, target_dtype)`` lists as numeric."""
    rows = conversions.filter(F.col("target_dtype") == "numeric").select("column_name").collect()
    listed = [r[0] for r in rows if r[0] in df.columns]  # a hand-reviewed sheet
    texts = set(text_columns(df))
    return _replace(
        df, {c: to_number(F.col(c)) if c in texts else F.col(c).cast("double") for c in listed}
    )


def detect_conversions(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Text columns of which more than ``threshold`` of all rows parse as numbers."""
    texts = text_columns(df)
    rates = df.agg(*[F.avg(to_number(F.col(c)).isNotNull().cast("double")).alias(c) for c in texts])
    long = rates.unpivot([], texts, "column_name", "success_rate")
    return long.filter(F.col("success_rate") > threshold).select(
        "column_name",
        F.lit("object").alias("source_dtype"),
        F.lit("numeric").alias("target_dtype"),
        "success_rate",
    )


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN to 0 in numeric columns."""
    return df.na.fill(0, subset=list(columns) if columns is not None else numeric_columns(df))


# --- blanking ---------------------------------------------------------------------------------


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest on ties; missing values do not count.

    One pass: (field, value) counts are combined map-side and spread by field and value, then the
    winners are picked per type from partial maxima.
    """
    if not columns:
        return {}
    counted = {}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in by_type.values():
        pairs = F.array(
            *[
                F.struct(
                    F.lit(c).alias("field"),
                    missing_to_null(F.col(c), df.schema[c].dataType).alias("value"),
                )
                for c in names
            ]
        )
        counts = (
            df.select(F.inline(pairs))
            .filter(F.col("value").isNotNull())
            .groupBy("field", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = counts.groupBy("field").agg(F.min(F.struct(-F.col("n"), "value")).alias("best"))
        counted |= {r["field"]: r["best"]["value"] for r in best.collect()}  # one row per column
    return counted


def blank_out(df: DataFrame, fields: Sequence[str], non_boolean: Sequence[str] = ()) -> DataFrame:
    """Take the information out of columns: the mode for non-boolean fields, else 0 or false."""
    present = [f for f in fields if f in df.columns]
    mode = modes(df, [f for f in present if f in non_boolean])
    new = {}
    for f in present:
        dtype = df.schema[f].dataType
        value = mode.get(f) if f in non_boolean else (False if isinstance(dtype, T.BooleanType) else 0)
        new[f] = F.lit(value).cast(dtype)
    return _replace(df, new)


# --- model input ------------------------------------------------------------------------------


def model_prep(
    df: DataFrame,
    features: Sequence[str],
    numerator: str,
    denominator: str,
    weight: str,
    offset: str | None = None,
    aggregate: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Model rows: features, rate target and facts, with non-positive weights filtered out.

    ``aggregate`` sums the facts over equal feature vectors first; a missing level stays a group of
    its own and is filled with 0 afterwards. The offset is a group key then.
    """
    facts = list(dict.fromkeys([numerator, denominator, weight]))
    keys = [*features, *([offset] if offset else [])]
    if aggregate:
        # NaN and null are one missing level
        keyed = df.select(
            *[missing_to_null(F.col(c), df.schema[c].dataType).alias(c) for c in keys], *facts
        )
        rows = keyed.groupBy(*keys).agg(*[F.sum(f).alias(f) for f in facts])
        columns = [*keys, *facts]
    else:
        rows, columns = df, [*keep, *keys, *facts]
    rows = fill_missing(rows.select(*dict.fromkeys(columns)))
    num, den = F.col(numerator), F.col(denominator)
    valid = rows.filter((F.col(weight) > 0) & (den > 0) & (num >= 0))
    return valid.withColumn("target", F.try_divide(num.cast("double"), den.cast("double")))


# --- profiles ---------------------------------------------------------------------------------


def missing_profile(df: DataFrame) -> DataFrame:
    """``(column_name, missing, missing_pct)`` of the columns with missing values."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(is_missing(F.col(f.name), f.dataType), 1)).alias(f.name) for f in df.schema],
    )
    long = counts.unpivot(["__rows"], names, "column_name", "missing")
    return long.filter(F.col("missing") > 0).select(
        "column_name",
        "missing",
        F.try_divide(F.col("missing") * 100.0, F.col("__rows")).alias("missing_pct"),
    )


def target_stats(df: DataFrame, target: str) -> DataFrame:
    """One row: non-missing count, mean, sample deviation, exact median, least and largest value."""
    if target not in df.columns:
        raise ValueError(f"Target {target} not found among {df.columns[:20]}")
    value = missing_to_null(F.col(target), df.schema[target].dataType).cast("double")
    median = quantiles(df, target, [0.5])[0]
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).withColumn("median", F.lit(median))


def fold_counts(
    df: DataFrame, train_folds: Sequence[int], test_fold: int, fold: str = "fold"
) -> DataFrame:
    label = (
        F.when(F.col(fold).isin(*train_folds), "TRAIN").when(F.col(fold) == test_fold, "TEST")
    ).otherwise("other")
    counts = df.groupBy(fold).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(fold, "rows", label.alias("role"))


def verification_report(df: DataFrame, target: str, fold: str = "fold") -> DataFrame:
    """Rows ``(section, name, value)``: shape, target statistics, rows per fold."""
    value = missing_to_null(F.col(target), df.schema[target].dataType).cast("double")
    stats = {
        ("shape", "rows"): F.count(F.lit(1)).cast("double"),
        ("shape", "columns"): F.lit(float(len(df.columns))),
        ("target", "mean"): F.avg(value),
        ("target", "std"): F.stddev_samp(value),
        ("target", "min"): F.min(value),
        ("target", "max"): F.max(value),
    }
    one = df.agg(*[c.alias(f"{s}_{n}") for (s, n), c in stats.items()])
    rows = one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("section"), F.lit(n).alias("name"), F.col(f"{s}_{n}").alias("value")
                    )
                    for s, n in stats
                ]
            )
        )
    )
    folds = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("fold").alias("section"),
        F.col(fold).cast("string").alias("name"),
        F.col("n").cast("double").alias("value"),
    )
    return rows.unionByName(folds)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
