"""Column catalogs and the plans made from them.

A catalog is a DataFrame ``(column_name, dtype, notes)``. It comes from the file schema, so none
of these operators reads rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Name prefixes that point to loss or premium information.
LEAKAGE_PATTERNS = (
    "claim", "ee_", "incurred", "incloss", "pp_", "loss", "paid", "reserve", "premium",
)

# Target and exposure columns, never features.
TARGETS = (
    "pp_bi", "pp_pd", "pp_pip", "pp_coll", "pp_comp",
    "ee_bi", "ee_pd", "ee_pip", "ee_coll", "ee_comp",
)

_CATALOG = "column_name string, dtype string, notes string"

# Catalog names of the Spark types that are called differently in Parquet catalogs.
_DTYPE_NAMES = {
    "bigint": "int64",
    "int": "int32",
    "smallint": "int16",
    "tinyint": "int8",
    "boolean": "bool",
    "timestamp": "timestamp[us]",
    "timestamp_ntz": "timestamp[us]",
}


def dtype_name(dtype: T.DataType) -> str:
    """Name of a type as column catalogs write it."""
    if isinstance(dtype, T.DecimalType):
        return f"decimal128({dtype.precision}, {dtype.scale})"
    return _DTYPE_NAMES.get(dtype.simpleString(), dtype.simpleString())


def export_schema(df: DataFrame) -> DataFrame:
    rows = [(f.name, dtype_name(f.dataType), "") for f in df.schema]
    return df.sparkSession.createDataFrame(rows, _CATALOG)


def type_distribution(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("dtype").agg(F.count(F.lit(1)).alias("columns"))


# --- load plan --------------------------------------------------------------------------------


def load_plan(
    catalog: DataFrame, features: DataFrame, essential: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Columns to load, tagged ``essential`` or ``feature``, and wanted columns the catalog lacks.

    ``features`` is an inclusion list with a ``column_name`` column.
    """
    spark = catalog.sparkSession
    needed = spark.createDataFrame([(c,) for c in essential], "column_name string")
    source = F.when(F.col("column_name").isin(*essential), "essential").otherwise("feature")
    wanted = (
        needed.union(features.select("column_name"))
        .distinct()
        .select("column_name", source.alias("source"), F.lit("").alias("notes"))
    )
    return (
        wanted.join(catalog, "column_name", "left_semi"),
        wanted.join(catalog, "column_name", "left_anti"),
    )


def load_reduction(catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: columns in the file, to load, skipped, and the reduction in percent."""
    loaded = plan.agg(F.count(F.lit(1))).scalar()
    counts = catalog.agg(F.count(F.lit(1)).alias("total")).withColumn("loaded", loaded)
    skipped = F.col("total") - F.col("loaded")
    return counts.select(
        "total",
        "loaded",
        skipped.alias("skipped"),
        F.try_divide(skipped * 100.0, F.col("total")).alias("reduction_pct"),
    )


# --- column selection -------------------------------------------------------------------------


def included(columns: Sequence[str], inclusion: Sequence[str] | None) -> list[str]:
    """Whitelisted columns that exist, in whitelist order; no whitelist keeps all."""
    if inclusion is None:
        return list(columns)
    return [c for c in inclusion if c in columns]


def always_excluded(exclusion: Sequence[str] = ()) -> set[str]:
    return set(TARGETS) | set(exclusion)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)
    ]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)
    ]


def boolean_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.BooleanType) and f.name not in set(exclude)
    ]


def columns_with_prefix(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def facts_and_features(
    columns: Sequence[str], fact_marks: Sequence[str], ignore: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """Fact columns hold one of ``fact_marks`` in their name; features are the rest."""
    facts = [c for c in columns if any(m in c for m in fact_marks)]
    return facts, [c for c in columns if c not in facts and c not in ignore]


def feature_list(df: DataFrame, prefix: str) -> DataFrame:
    """Selection sheet to be filled in by hand: all features, none selected, none blanked."""
    rows = [(c, 0, 0) for c in columns_with_prefix(df.columns, prefix)]
    return df.sparkSession.createDataFrame(rows, "feature_name string, selected int, blank int")


# --- leakage ----------------------------------------------------------------------------------


def leakage_pattern(name: Column, patterns: Sequence[str] = LEAKAGE_PATTERNS) -> Column:
    """First pattern the lower-case name starts with, null if none."""
    lower = F.lower(name)
    return F.coalesce(*[F.when(lower.startswith(p), F.lit(p)) for p in patterns])


def leaking(columns: Sequence[str], patterns: Sequence[str] = LEAKAGE_PATTERNS) -> list[str]:
    """Columns whose lower-case name starts with a pattern."""
    return [c for c in columns if c.lower().startswith(tuple(patterns))]


def leakage_scan(
    catalog: DataFrame, excluded: DataFrame, patterns: Sequence[str] = LEAKAGE_PATTERNS
) -> DataFrame:
    """Suspicious columns ``(column_name, pattern, leaker, csv_row)``.

    A leaker is not yet in ``excluded``; its ``csv_row`` can be pasted into the exclusion list.
    """
    found = catalog.select(
        "column_name", leakage_pattern(F.col("column_name"), patterns).alias("pattern")
    ).filter(F.col("pattern").isNotNull())
    known = excluded.select("column_name").distinct().withColumn("known", F.lit(True))
    leaker = F.col("known").isNull()
    return found.join(known, "column_name", "left").select(
        "column_name",
        "pattern",
        leaker.alias("leaker"),
        # Fixed value: text of an exclusion row
        F.when(leaker, F.concat_ws(",", "column_name", F.lit("data_leakage"), F.lit("leakage"))).alias(
            "csv_row"
        ),
    )
