"""Hand-written settings sheets: reshaping, option lists, monotone directions.

Sheets have some dozen rows. They are read as text (CSV) and reshaped in Spark; the few values
that parameterise later plans are collected by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from liftworks.operators.assemble import semi_filter
from liftworks.operators.ordered import fill_forward, first_positions

# Fixed value: mark of a field that is to be blanked out.
BLANK = "x"


def reshape_settings(
    sheet: DataFrame,
    catalog: DataFrame,
    veh_type: str,
    cov: str,
    position: str = "pos",
    rows: int | None = None,
) -> DataFrame:
    """Sheet with a row per category and a column per field, to a row per field.

    Rows marked ``-``, and rows after the first ``rows`` if given, are dropped, gaps are filled downwards, one
    vehicle type and coverage is kept, and each field gets its type from the catalog.
    """
    keys = [position, "veh_type", "cov", "category"]
    fields = [c for c in sheet.columns if c not in keys]
    marked = sheet.filter(F.col("veh_type").isNull() | (F.col("veh_type") != "-"))
    cut = marked if rows is None else first_positions(marked, position, rows)
    filled = fill_forward(cut, [c for c in sheet.columns if c != position], position)
    picked = filled.filter((F.col("veh_type") == veh_type) & (F.col("cov") == cov))
    long = picked.select("category", *fields).unpivot("category", fields, "field", "setting")
    wide = long.groupBy("field").pivot("category", ["mono", "low_clip", "high_clip"]).agg(
        F.first("setting")
    )
    types = catalog.select(F.col("column_name").alias("field"), "dtype")
    return wide.join(F.broadcast(types), "field")  # one row per column of a table


def blanked(settings: DataFrame) -> DataFrame:
    """Fields to blank out, and whether they are boolean or numeric."""
    kind = F.when(F.col("dtype") == "bool", "bool").otherwise("num")
    return settings.filter(F.col("mono") == BLANK).select("field", kind.alias("kind"))


def option_settings(
    sheet: DataFrame, veh_type: str, catalog: DataFrame, type_column: str = "vc_Vehicle_Type_M"
) -> DataFrame:
    """``(field, mono)`` of one vehicle type, for fields the data has."""
    picked = sheet.filter(F.col(type_column) == veh_type).select("field", "mono")
    return semi_filter(picked, catalog.select(F.col("column_name").alias("field")), "field")


def monotone_directions(
    spark, features: Sequence[str], trim: DataFrame, options: DataFrame, unlisted: int | None = 0
) -> DataFrame:
    """``(field, mono)``: first setting found per feature, blanked fields 0.

    Features without a setting get ``unlisted``, or are left out if that is ``None``.
    """
    named = spark.createDataFrame([(f,) for f in features], "field string")
    trim = trim.select("field", F.col("mono").alias("trim_mono"))
    options = options.select("field", F.col("mono").alias("options_mono"))
    mono = F.coalesce("trim_mono", "options_mono")
    code = F.when(mono == BLANK, 0).otherwise(mono.try_cast("int"))
    if unlisted is not None:
        code = F.coalesce(code, F.lit(unlisted))
    return (
        named.join(trim, "field", "left")
        .join(options, "field", "left")
        .select("field", code.alias("mono"))
        .dropna(subset=["mono"])
    )


def constraint_text(mono: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row ``(constraints)``: the directions in feature order, as ``(1, 0, -1)``."""
    order = F.array(*[F.lit(f) for f in features])
    listed = F.sort_array(F.collect_list(F.struct(F.array_position(order, F.col("field")), "mono")))
    return mono.filter(F.array_contains(order, F.col("field"))).agg(
        F.translate(listed["mono"].cast("string"), "[]", "()").alias("constraints")
    )
