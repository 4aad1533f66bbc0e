"""Feature encoding: fit on training rows, apply as one projection.

Fitting profiles all columns in one pass (``profiles``): sets of values up to the guard, ranges, and
sketches beyond. What is shuffled and what reaches the driver is bounded by the guard. Transforming is a single ``select`` without a shuffle; only label codes of
text columns with many categories are joined, from a table of (category, code) made in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from liftworks.functions import (
    binary_map,
    label_code,
    missing_to_null,
    one_hot,
    remap_level,
    text_or_nan,
)
from liftworks.operators.catalog import always_excluded, numeric_columns, text_columns
from liftworks.operators.ordered import running_totals
from liftworks.operators.profiles import Profile, profile
from liftworks.sources import stage

# Level groups of the binary encodings.
LOW_0_2 = ({0, 1, 2}, {3, 4, 5})
LOW_0_3 = ({0, 1, 2, 3}, {4, 5})
LOW_0_1_4 = ({0, 1, 4}, {3, 5})

SCHEMES = ("ordinal", "binary", "mapped", "custom")
BROADCAST_CODES = 200_000  # rows of a code table, some MB
MAX_UNIQUE = 100
MAX_DISTINCT = 7


# --- profiling --------------------------------------------------------------------------------


def _long(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in values.items()]
    return df.select(F.inline(F.array(*pairs)))


def _number(df: DataFrame, c: str) -> Column:
    return missing_to_null(F.col(c), df.schema[c].dataType).cast("double")


def _is_ordinal(found: Profile, lo: float = 0, hi: float = 5, max_distinct: int = 7) -> bool:
    """At most ``max_distinct`` values, at least one, all within lo..hi."""
    return bool(found.values) and len(found.values) <= max_distinct and found.lo >= lo and found.hi <= hi


def detect_ordinal(
    df: DataFrame, columns: Sequence[str], lo: float = 0, hi: float = 5, max_distinct: int = MAX_DISTINCT
) -> DataFrame:
    """``(field, is_ordinal)``: at most ``max_distinct`` distinct values, all within lo..hi."""
    found = profile(df, {c: _number(df, c) for c in columns}, {}, max_distinct, 0)
    rows = [(c, _is_ordinal(found[c], lo, hi, max_distinct)) for c in columns]
    return df.sparkSession.createDataFrame(rows, "field string, is_ordinal boolean")


def guard_report(df: DataFrame, columns: Sequence[str], max_unique: int = MAX_UNIQUE) -> DataFrame:
    """``(field, n_unique, exact, safe)``: exact counts up to ``max_unique``, estimates above; missing not
    counted. One pass whose shuffle does not grow with the distinct values."""
    found = profile(df, {}, {c: F.col(c).cast("string") for c in columns}, 0, max_unique)
    rows = [(c, round(p.distinct), p.values is not None, p.values is not None) for c, p in found.items()]
    return df.sparkSession.createDataFrame(rows, "field string, n_unique bigint, exact boolean, safe boolean")


def cardinality(df: DataFrame, columns: Sequence[str], max_unique: int = MAX_UNIQUE) -> DataFrame:
    """``(field, n_unique, safe)``: a report of exact counts whatever their size, which shuffles distinct
    values; missing not counted. Fits use ``profiles``, and ``guard_report`` estimates counts above the guard."""
    if not columns:
        return df.sparkSession.createDataFrame([], "field string, n_unique bigint, safe boolean")
    pairs = _long(df, {c: F.col(c).cast("string") for c in columns})
    found = pairs.distinct().groupBy("field").agg(F.count("value").alias("n_unique"))
    return found.select("field", "n_unique", (F.col("n_unique") <= max_unique).alias("safe"))


def fit_categories(
    df: DataFrame, columns: Mapping[str, Column] | Sequence[str], max_unique: int = MAX_UNIQUE
) -> dict[str, list[str]]:
    """Sorted categories of each column with at most ``max_unique``; others are left out.

    Missing is the category ``nan`` and does not count towards the guard.
    """
    values = columns if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    return _categories(profile(df, {}, _texts(values), 0, max_unique + 1), values, max_unique)


def _texts(values: Mapping[str, Column]) -> dict[str, Column]:
    return {n: text_or_nan(c) for n, c in values.items()}


def _categories(found: Mapping[str, Profile], names, max_unique: int) -> dict[str, list[str]]:
    """Categories from profiles whose guard is one more, for ``nan``."""
    return {
        n: list(found[n].values)
        for n in names
        if found[n].values is not None and len([v for v in found[n].values if v != "nan"]) <= max_unique
    }


def code_table(df: DataFrame, column: str) -> DataFrame:
    """``(category, code)`` of a text column with any number of categories, in sorted order."""
    values = stage(df.select(F.col(column).alias("category")).dropna().distinct(), "categories")
    ranked = running_totals(values, ["category"], {"rank": F.lit(1).cast("bigint")})
    return stage(ranked.select("category", (F.col("rank") - 1).cast("double").alias("code")), "codes")


# --- fitted state -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """How one input column becomes output columns."""

    column: str
    kind: str  # pass, binary, remap, custom, one_hot, remap_one_hot, label, label_table
    low: frozenset[int] = frozenset()
    high: frozenset[int] = frozenset()
    categories: tuple[str, ...] = ()

    def outputs(self) -> list[Column]:
        name, col = self.column, F.col(self.column)
        if self.kind == "pass":
            return [col.cast("float").alias(name)]
        if self.kind == "binary":
            return [binary_map(col, self.low, self.high).alias(name)]
        if self.kind == "remap":
            return [remap_level(col, 2, 4).alias(name)]
        if self.kind == "custom":
            return [binary_map(remap_level(col, 2, 4), self.low, self.high).alias(name)]
        if self.kind == "one_hot":
            return one_hot(col, name, self.categories)
        if self.kind == "remap_one_hot":
            return one_hot(remap_level(col, 2, 4), name, self.categories)
        if self.kind == "label":
            return [label_code(col, self.categories).alias(name)]
        return [F.coalesce(F.col(f"__code_{name}"), F.lit(-1.0)).alias(name)]

    def names(self) -> list[str]:
        if self.kind in ("one_hot", "remap_one_hot"):
            return [f"{self.column}__{c}" for c in self.categories]
        return [self.column]


@dataclass(frozen=True)
class EncoderState:
    """Fitted encoder; ``transform`` treats training and test rows alike."""

    scheme: str
    steps: tuple[Step, ...]
    include: tuple[str, ...] | None = None
    skipped: tuple[str, ...] = ()
    code_tables: Mapping[str, DataFrame] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        names = [n for s in self.steps for n in s.names()]
        return names if self.include is None else [n for n in names if n in self.include]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Encoded features as float columns (numbers of joined categories as double), with the columns of ``keep`` in front."""
        wanted = set(self.feature_names)
        for name, codes in self.code_tables.items():
            codes = codes.select(
                F.col("category").alias(f"__cat_{name}"), F.col("code").alias(f"__code_{name}")
            )
            # a dominant category is one key: small tables are broadcast, others joined by shuffle
            if codes.count() <= BROADCAST_CODES:
                codes = F.broadcast(codes)
            df = df.join(codes, F.col(name) == F.col(f"__cat_{name}"), "left")
        outputs = [
            out for s in self.steps for out, n in zip(s.outputs(), s.names()) if n in wanted
        ]
        return df.select(*keep, *outputs)


def _mapped_steps(
    df: DataFrame, strategies: Mapping[str, str], numeric: Sequence[str], text: Sequence[str],
    max_unique: int, on_wide: str,
) -> tuple[list[Step], list[str], dict[str, DataFrame]]:
    plan = {c: strategies.get(c) or "not_specified" for c in [*numeric, *text]}
    one_hots = {c: F.col(c) for c, s in plan.items() if s in ("ohe", "group_ohe")}
    one_hots |= {c: remap_level(F.col(c), 2, 4) for c, s in plan.items() if s == "ohe_map2to4"}
    labels = [c for c in text if plan[c] in ("ordered", "not_specified")]
    categories = fit_categories(df, one_hots | {c: F.col(c) for c in labels}, max_unique)
    steps, skipped, tables = [], [], {}
    for c, strategy in plan.items():
        if strategy == "drop":
            continue
        if strategy in ("ordered", "not_specified"):
            if c not in labels:
                steps.append(Step(c, "pass"))
            elif c in categories:
                known = tuple(v for v in categories[c] if v != "nan")
                steps.append(Step(c, "label", categories=known))
            else:
                tables[c] = code_table(df, c)
                steps.append(Step(c, "label_table"))
        elif strategy in ("binary_low_hi", "binary_lo_high"):
            low, high = LOW_0_2 if strategy == "binary_low_hi" else LOW_0_3
            steps.append(Step(c, "binary", frozenset(low), frozenset(high)))
        elif strategy == "h_map2to4":
            steps.append(Step(c, "remap"))
        elif strategy in ("ohe", "group_ohe", "ohe_map2to4"):
            kind = "remap_one_hot" if strategy == "ohe_map2to4" else "one_hot"
            if c in categories:
                steps.append(Step(c, kind, categories=tuple(categories[c])))
            else:
                skipped.append(c)
                if on_wide == "codes":
                    tables[c] = code_table(df, c)
                    steps.append(Step(c, "label_table"))
        else:
            raise ValueError(f"unknown strategy {strategy} for {c}")
    return steps, skipped, tables


def fit_encoder(
    df: DataFrame,
    scheme: str,
    mapping: Mapping[str, str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    max_unique: int = MAX_UNIQUE,
    on_wide: str = "error",
) -> EncoderState:
    """Fit one of the encoding schemes on training rows.

    * ``ordinal`` keeps numbers and one-hot encodes text
    * ``binary`` also collapses 0-5 columns to {0,1,2} against {3,4,5}
    * ``mapped`` follows ``mapping``, a strategy per column
    * ``custom`` collapses 0-5 columns after moving level 2 to 4, {0,1,4} against {3,5}

    Text columns with more than ``max_unique`` categories are not one-hot encoded; ``on_wide`` says
    what happens to them: ``error``, ``drop`` (listed in ``skipped``) or ``codes`` (one column of
    category numbers). ``include`` is a whitelist of encoded names.
    """
    if on_wide not in ("error", "drop", "codes"):
        raise ValueError("on_wide is 'error', 'drop' or 'codes'")

    if scheme not in SCHEMES:
        raise ValueError(f"unknown scheme {scheme}")
    skip = always_excluded(exclude)
    numeric, text = numeric_columns(df, skip), text_columns(df, skip)
    white = tuple(include) if include is not None else None
    if scheme == "mapped":
        steps, skipped, tables = _mapped_steps(df, mapping or {}, numeric, text, max_unique, on_wide)
        _refuse(skipped, on_wide, max_unique)
        return EncoderState(scheme, tuple(steps), white, tuple(skipped), tables)

    levels = numeric if scheme in ("binary", "custom") else []
    found = profile(
        df, {c: _number(df, c) for c in levels}, _texts({c: F.col(c) for c in text}), MAX_DISTINCT, max_unique + 1
    )
    ordinal = {c for c in levels if _is_ordinal(found[c])}
    low, high = LOW_0_2 if scheme == "binary" else LOW_0_1_4
    kind = "binary" if scheme == "binary" else "custom"
    steps = [
        Step(c, kind, frozenset(low), frozenset(high)) if c in ordinal else Step(c, "pass")
        for c in numeric
    ]
    categories = _categories(found, text, max_unique)
    steps += [Step(c, "one_hot", categories=tuple(categories[c])) for c in text if c in categories]
    skipped = tuple(c for c in text if c not in categories)
    _refuse(skipped, on_wide, max_unique)
    tables = {c: code_table(df, c) for c in skipped} if on_wide == "codes" else {}
    steps += [Step(c, "label_table") for c in tables]
    return EncoderState(scheme, tuple(steps), white, skipped, tables)


def _refuse(wide: Sequence[str], on_wide: str, max_unique: int) -> None:
    if wide and on_wide == "error":
        raise ValueError(f"more than {max_unique} categories: {list(wide)}; pass on_wide to drop or number them")
