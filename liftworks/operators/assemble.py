"""Assembly of the modelling table: key resolution, folds, joins, splits, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from liftworks.operators.ordered import ROWS_PER_RANGE, smallest

# Spellings under which the join key is looked for, after the configured one.
KEY_ALIASES = ("VIN_Date", "vindate", "vin_date", "VINDATE")


def resolve_key(columns: Sequence[str], configured: str) -> str:
    """Name under which a table holds the join key."""
    for name in (configured, *KEY_ALIASES):
        if name in columns:
            return name
    raise ValueError(f"Join key {configured} not found among {list(columns)}")


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Rename the join key to ``key`` if the table spells it otherwise."""
    found = resolve_key(df.columns, key)
    return df if found == key else df.withColumnRenamed(found, key)


def folds_for(level: int, mapping: Mapping[int, Sequence[int]], test_fold: int) -> list[int]:
    """Folds to load at a debug level: its training folds and the test fold."""
    return [*mapping[level], test_fold]


def fold_filter(df: DataFrame, folds: Sequence[int], fold: str = "fold") -> DataFrame:
    if fold not in df.columns:
        raise ValueError(f"Fold column {fold} not found")
    return df.filter(F.col(fold).isin(*folds))


def assemble(master: DataFrame, aux: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join the wide table to the table that owns folds and targets.

    Columns on both sides get the suffixes ``_x`` and ``_y``. Rows without a key do not match.
    """
    aux_key = resolve_key(aux.columns, key)
    aux, master = with_key(aux, aux_key), with_key(master, aux_key)
    both = (set(master.columns) & set(aux.columns)) - {aux_key}

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(c + suffix if c in both else c) for c in df.columns])

    return _join(suffixed(master, "_x"), suffixed(aux, "_y"), aux_key, how)


def _join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join; in a left join, rows without a key don't travel: they would all meet in one task."""
    if how not in ("left", "left_outer", "leftouter"):
        return left.join(right, key, how)
    joined = left.filter(F.col(key).isNotNull()).join(right, key, "left")
    new = {c: F.lit(None).cast(right.schema[c].dataType) for c in right.columns if c != key}
    alone = left.filter(F.col(key).isNull()).withColumns(new) if new else left.filter(F.col(key).isNull())
    return joined.unionByName(alone)


def join_new_columns(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join that takes from ``other`` only the columns ``df`` lacks."""
    new = [c for c in other.columns if c not in df.columns]
    return _join(df, other.select(key, *new), key, "left")


def semi_filter(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    return df.join(other.select(on), on, "left_semi")


def anti_filter(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    return df.join(other.select(on), on, "left_anti")


def split(df: DataFrame, is_train: Column) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a condition, such as a flag or a set of folds."""
    return df.filter(is_train), df.filter(~is_train)


def split_by_fold(
    df: DataFrame, train_folds: Sequence[int], test_fold: int, fold: str = "fold"
) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(fold).isin(*train_folds)), df.filter(F.col(fold) == test_fold)


# --- samples ----------------------------------------------------------------------------------


def first_rows(
    df: DataFrame, key: str, n: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """The ``n`` rows of smallest key."""
    return smallest(df, [key], n, rows_per_range)


def draw(key: str, seed: int) -> Column:
    """A number in hexadecimal digits that depends on key and seed only, evenly spread."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows; the same rows in every run and for every partitioning.

    The first 40 bits of ``draw`` decide, so fractions down to 1e-12 are told apart.
    """
    if fraction >= 1.0:
        return df
    limit = f"{max(0, round(fraction * 2**40)):010x}"
    return df.filter(F.substring(draw(key, seed), 1, 10) < limit)


def fixed_sample(
    df: DataFrame, key: str, n: int = 10_000, seed: int = 42, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``n`` rows (all, if fewer) in an order that depends on key and seed only."""
    drawn = df.withColumn("__draw", draw(key, seed))
    return smallest(drawn, ["__draw", key], n, rows_per_range).drop("__draw")


# --- loading for a fit ------------------------------------------------------------------------


def downcast(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Doubles to float; longs to int where the column's range fits.

    One aggregate looks at the ranges of all long columns.
    """
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType) and f.name not in keep]
    fits: set[str] = set()
    if longs:
        bounds = df.agg(
            *[F.min(c).alias(f"lo_{c}") for c in longs], *[F.max(c).alias(f"hi_{c}") for c in longs]
        ).first()
        fits = {
            c
            for c in longs
            if bounds[f"lo_{c}"] is not None
            and bounds[f"lo_{c}"] >= -(2**31)
            and bounds[f"hi_{c}"] < 2**31
        }

    def cast(field: T.StructField) -> Column:
        col = F.col(field.name)
        if field.name in keep:
            return col
        if isinstance(field.dataType, T.DoubleType):
            return col.cast("float").alias(field.name)
        if field.name in fits:
            return col.cast("int").alias(field.name)
        return col

    return df.select(*[cast(f) for f in df.schema])


def load(
    df: DataFrame,
    target: str,
    key: str,
    mode: str = "full",
    n: int = 10_000,
    fraction: float = 0.10,
    numeric_text: Sequence[str] | None = None,
    seed: int = 42,
    on_leakage: str = "ignore",
) -> DataFrame:
    """Rows for a fit: all, the first ``n`` or a fraction; text coerced; target not missing.

    ``numeric_text`` defaults to the fixed list of columns known to hold numbers as text. The
    leakage scan always runs; ``on_leakage="error"`` raises if it finds columns.
    """
    from liftworks.operators.catalog import leaking
    from liftworks.operators.condition import NUMERIC_TEXT_COLUMNS, coerce_numeric, has_value

    if on_leakage not in ("ignore", "error"):
        raise ValueError("on_leakage is 'ignore' or 'error'")
    found = leaking(df.columns)
    if found and on_leakage == "error":
        raise ValueError(f"columns that leak the target: {found}")
    if mode == "first":
        df = first_rows(df, key, n)
    elif mode == "fraction":
        df = hash_sample(df, key, fraction, seed)
    elif mode != "full":
        raise ValueError(f"unknown mode {mode}")
    listed = NUMERIC_TEXT_COLUMNS if numeric_text is None else numeric_text
    df = coerce_numeric(df, [c for c in listed if c in df.columns])
    return downcast(has_value(df, target), keep=[key])
