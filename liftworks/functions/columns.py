"""Column expressions. All are built-in Spark expressions, so they stay in whole-stage codegen.

"Missing" means SQL null or floating-point NaN: the data model knows one kind of missing value,
Spark knows two. Functions that must tell them apart take the column's Spark type.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F, types as T

_FLOATING = (T.DoubleType, T.FloatType)


def is_missing(col: Column, dtype: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    if isinstance(dtype, _FLOATING):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def missing_to_null(col: Column, dtype: T.DataType) -> Column:
    """Fold NaN into null, so that aggregates skip it."""
    if isinstance(dtype, _FLOATING):
        return F.when(~F.isnan(col), col)
    return col


def round_digits(col: Column, digits: int) -> Column:
    """Scale, round half to even, unscale - on the binary double, unlike ``round`` and ``bround``."""
    scale = float(10**digits)
    return F.rint(col.cast("double") * scale) / F.lit(scale)


def round_step(col: Column, step: float) -> Column:
    """Nearest multiple of ``step`` (half to even); a step of 0 leaves the column alone."""
    if step == 0:
        return col
    return F.rint(col.cast("double") / F.lit(float(step))) * F.lit(float(step))


def clip(col: Column, low: float | None, high: float | None) -> Column:
    """Two-sided bound that lets missing values through.

    ``least``/``greatest`` would turn a null into the bound, and NaN compares as the largest
    double, so both are kept out of the comparison.
    """
    value = col.cast("double")
    out = value
    if high is not None:
        out = F.when((value > float(high)) & ~F.isnan(value), float(high)).otherwise(out)
    if low is not None:
        out = F.when(value < float(low), float(low)).otherwise(out)
    return out


# Fixed value: text that counts as a number.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def to_number(col: Column) -> Column:
    """Parse text to double; what does not parse becomes null.

    The pattern comes first because a failing parse raises and catches an exception per row.
    """
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def text_or_nan(col: Column) -> Column:
    """Text of a value, with missing values (null or NaN) as the token ``nan``."""
    return F.coalesce(F.nullif(col.cast("string"), F.lit("NaN")), F.lit("nan"))


def per_hundred(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def binary_map(col: Column, low: Iterable[int], high: Iterable[int], unknown: int = 0) -> Column:
    """Levels of ``low`` to 0 and of ``high`` to 1 after half-even rounding.

    Other levels become ``unknown``; missing stays missing.
    """
    value = col.cast("double")
    level = F.rint(value)
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(None))
        .when(level.isin(*[float(v) for v in low]), 0.0)
        .when(level.isin(*[float(v) for v in high]), 1.0)
        .otherwise(float(unknown))
        .cast("float")
    )


def remap_level(col: Column, source: int, target: int) -> Column:
    """Move one (rounded) level onto another and keep the rest; missing stays missing."""
    value = col.cast("double")
    hit = F.rint(value) == float(source)
    return F.when(hit, float(target)).when(~F.isnan(value), value).cast("float")


def one_hot(col: Column, name: str, categories: Sequence[str]) -> list[Column]:
    """One 0/1 float column ``name__category`` per category; unseen values give all zeros."""
    text = text_or_nan(col)
    return [(text == c).cast("float").alias(f"{name}__{c}") for c in categories]


def label_code(col: Column, categories: Sequence[str]) -> Column:
    """Position in the sorted categories; -1 for missing and unseen values."""
    if not categories:
        return F.lit(-1.0).cast("float")
    position = F.array_position(F.array(*[F.lit(c) for c in categories]), col.cast("string"))
    return F.coalesce(position - 1, F.lit(-1)).cast("float")
