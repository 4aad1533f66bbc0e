"""Ordered operators over a whole table: running totals, weighted buckets, order statistics.

``Window.orderBy`` without a partition sends every row to one task. Here the total order is cut
into contiguous *ranges* instead. The cut points come from a bounded, evenly spread sample of the
order columns, so a value shared by a third of all rows is still split, by the later order
columns (end the order with a unique key). The range of a row is a pure function of the row,
hence the same in every pass and after a lost executor. Sampling decides balance only, never
results.

* ``running_totals`` needs every row in place: one shuffle by range, a window inside each range,
  and the totals of earlier ranges joined from a broadcast table of at most two rows per range.
* ``crossings`` looks for the few rows at which a monotone step function of the running total
  changes (decile cuts, quantiles). Range totals show which ranges hold a step; only those are
  sorted, everything else is a map-side aggregate.

* ``condensed`` makes ``crossings`` cheap on a large table: a weighted quantile summary brackets the steps, a
  second read keeps the rows inside the brackets and adds up all others. ``bucket_sums`` and
  ``quantiles`` read their input twice by it.

The others start jobs while the plan is being built and read their input up to four times: ``stage`` an
input that is costly to compute.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from liftworks.functions import missing_to_null
from liftworks.operators import summaries
from liftworks.sources import release, stage

ROWS_PER_RANGE = 250_000
MAX_RANGES = 16_384  # bounds the driver's list of cut points; beyond it ranges grow
WEIGHT_DIGITS = 10
_SAMPLES_PER_RANGE = 16
_RANGE = "__range"


# --- ranges -----------------------------------------------------------------------------------


def _plain(column: str, dtype: T.DataType) -> Column:
    """A value of the same order that JSON can carry: one literal then holds all bounds."""
    col = F.col(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(col, "UTC"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.cast("double")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.BooleanType)):
        return col.cast("int")
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    return col


@dataclass(frozen=True)
class Ranges:
    """Contiguous ranges of a total order; range ``i`` starts at ``bounds[i - 1]``.

    ``keys`` are the order columns' plain values, ``schema`` and ``bounds`` hold those.
    """

    keys: tuple[Column, ...]
    bounds: tuple[Row, ...]
    schema: T.StructType

    @property
    def count(self) -> int:
        return len(self.bounds) + 1

    def _literal(self, bounds: Sequence[Row]) -> Column:
        rows = [{k: str(v) if isinstance(v, Decimal) else v for k, v in b.asDict().items()} for b in bounds]
        return F.from_json(F.lit(json.dumps(rows)), T.ArrayType(self.schema))

    def here(self) -> Column:
        return F.struct(*[k.alias(n) for k, n in zip(self.keys, self.schema.names)])

    def start_of(self, number: int) -> Column:
        return F.get(self._literal(self.bounds[number - 1 : number]), F.lit(0))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the range id: a binary search, one projection per halving of the bounds.

        Select ranges by a join, not by a filter on the id: a filter would be pushed through the
        projections and repeat the search once per step.
        """
        df = df.withColumn(_RANGE, F.lit(0))
        if not self.bounds:
            return df
        bounds, here = self._literal(self.bounds), self.here()
        step = 1 << (len(self.bounds).bit_length() - 1)
        while step:
            at = F.get(bounds, F.col(_RANGE) + F.lit(step - 1))
            df = df.withColumn(_RANGE, F.col(_RANGE) + F.when(at <= here, step).otherwise(0))
            step //= 2
        return df


def split_ranges(
    df: DataFrame,
    order: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> Ranges:
    """Choose cut points so that ranges hold about ``rows_per_range`` of the ``rows``.

    The sample is a filter on a hash of the order columns, the same in every run; equal rows count
    once, so it stays near ``_SAMPLES_PER_RANGE`` rows per range.
    """
    keys = tuple(_plain(c, df.schema[c].dataType) for c in order)
    plain = df.select(*[k.alias(c) for k, c in zip(keys, order)])
    rows = df.count() if rows is None else rows
    wanted = min(MAX_RANGES, math.ceil(rows / rows_per_range))
    if wanted <= 1:
        return Ranges(keys, (), plain.schema)
    slots = 1 << 40
    share = min(1.0, wanted * _SAMPLES_PER_RANGE / rows)
    drawn = F.pmod(F.xxhash64(*order), F.lit(slots)) < int(share * slots)
    sample = plain.filter(drawn).distinct().orderBy(*order).collect()
    if not sample:
        return Ranges(keys, (), plain.schema)
    picked = [sample[len(sample) * i // wanted] for i in range(1, wanted)]
    return Ranges(keys, tuple(dict.fromkeys(picked)), plain.schema)


# --- running totals ---------------------------------------------------------------------------


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Inclusive running sum of each expression in ``sums``, per ``by`` group if given.

    Missing values count as 0, so a total is never missing and doesn't depend on the ranges. A group may be larger than a range: its earlier ranges are carried over like those of the
    ungrouped order.
    """
    df = df.select("*", *[c.alias(f"__v_{n}") for n, c in sums.items()])
    df = df.withColumns({f"__v_{n}": zero_if_missing(df, f"__v_{n}") for n in sums})
    ranges = split_ranges(df, [*by, *order], rows_per_range)
    placed = ranges.assign(df)
    window = (
        Window.partitionBy(_RANGE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    values = [f"__v_{n}" for n in sums]
    local = placed.select(
        *[c for c in placed.columns if c not in values],
        *[F.sum(f"__v_{n}").over(window).alias(n) for n in sums],
    )
    if ranges.count == 1:
        return local.drop(_RANGE)

    # only groups that hold a cut point reach across ranges: at most two rows per range in all
    totals = placed
    if by:
        cut_groups = df.sparkSession.createDataFrame(
            list({tuple(b[c] for c in by) for b in ranges.bounds}),
            T.StructType([df.schema[c] for c in by]),
        )
        same = [F.col(f"t.{c}").eqNullSafe(F.col(f"g.{c}")) for c in by]
        totals = totals.alias("t").join(F.broadcast(cut_groups).alias("g"), same, "left_semi")
    totals = totals.groupBy(_RANGE, *by).agg(*[F.sum(v).alias(v) for v in values])
    before = (
        Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        _RANGE, *by, *[F.sum(f"__v_{n}").over(before).alias(f"__c_{n}") for n in sums]
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (_RANGE, *by)]
    joined = local.alias("l").join(F.broadcast(carried).alias("c"), same, "left")
    kept = [c for c in local.columns if c not in sums and c != _RANGE]
    return joined.select(
        *[F.col(f"l.{c}") for c in kept],
        *[
            F.when(F.col(f"c.__c_{n}").isNull(), F.col(f"l.{n}"))
            .otherwise(F.col(f"l.{n}") + F.col(f"c.__c_{n}"))
            .alias(n)
            for n in sums
        ],
    )


def zero_if_missing(df: DataFrame, column: str) -> Column:
    dtype = df.schema[column].dataType
    return F.coalesce(missing_to_null(F.col(column), dtype), F.lit(0).cast(dtype))


# --- crossings --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Crossings:
    """First row of every level that a step function of the running total reaches."""

    base: int
    first: tuple[tuple[int, Row], ...]  # ascending by level
    schema: T.StructType

    def level(self) -> Column:
        """Level of any row, from its order columns alone."""
        here, out = F.struct(*self.schema.names), F.lit(self.base)
        for level, row in self.first:
            at = F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in self.schema])
            out = F.when(here >= at, level).otherwise(out)
        return out

    def at(self, level: int) -> Row | None:
        """First row at which the function is at least ``level``."""
        return next((row for reached, row in self.first if reached >= level), None)


def crossings(
    df: DataFrame,
    order: Sequence[str],
    weight: Column,
    rule: Callable[[Column, Column], Column],
    rows_per_range: int = ROWS_PER_RANGE,
) -> Crossings:
    """Rows at which ``rule(running weight, total weight)`` steps up.

    ``rule`` must not decrease along the order, so weights must not be negative. Missing weights
    count as 0. Fractional weights are summed as decimals of ``WEIGHT_DIGITS`` places, to which they
    are rounded, so that a sum doesn't depend on the order of adding, hence not on the ranges.
    """
    df = df.select(*order, weight.alias("__w"))
    df = df.withColumn("__w", zero_if_missing(df, "__w"))
    schema = T.StructType([df.schema[c] for c in order])
    if isinstance(df.schema["__w"].dataType, (T.DoubleType, T.FloatType)):
        df = df.withColumn("__w", F.col("__w").cast(f"decimal(28,{WEIGHT_DIGITS})"))
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("__w").alias("total"), F.min("__w").alias("least")
    ).first()
    if seen["total"] is None or seen["total"] <= 0:
        raise ValueError("sum of weights must be > 0")
    if seen["least"] < 0:
        raise ValueError("weights must be >= 0")
    total = F.lit(seen["total"])

    def level(running: Column) -> Column:
        return rule(running, total)

    ranges = split_ranges(df, order, rows_per_range, seen["rows"])
    placed = ranges.assign(df)
    if ranges.count > 1:
        placed = _stepping_rows(placed, level)
    else:
        placed = placed.withColumn("start", F.lit(0))
    inside = Window.partitionBy(_RANGE).orderBy(*order)
    upto = F.sum("__w").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum("__w").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    found = (
        placed.withColumns({"__upto": upto, "__before": before})
        .select(
            F.struct(*order).alias("row"),
            level(F.col("start") + F.col("__upto")).alias("level"),
            level(F.when(F.col("__before").isNull(), F.col("start")).otherwise(
                F.col("start") + F.col("__before")
            )).alias("previous"),
        )
        .filter(F.col("level") > F.col("previous"))
        .collect()  # at most one row per level
    )
    base = df.sparkSession.range(1).select(level(F.lit(0))).first()[0]
    return Crossings(base, tuple(sorted((f["level"], f["row"]) for f in found)), schema)


def _stepping_rows(placed: DataFrame, level: Callable[[Column], Column]) -> DataFrame:
    """Rows of the ranges in which the level steps, with the running total before their range."""
    sums = placed.groupBy(_RANGE).agg(F.sum("__w").alias("w"))
    before = Window.partitionBy().orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast(sums.schema["w"].dataType)
    sums = sums.select(  # one row per range
        _RANGE,
        F.coalesce(F.sum("w").over(before), nothing).alias("start"),
        F.sum("w").over(before.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
    )
    steps = sums.withColumns(
        {"at_start": level(F.col("start")), "at_end": level(F.col("end"))}
    ).collect()  # at most MAX_RANGES rows
    kept = [s for s in steps if s["at_end"] != s["at_start"]]
    starts = placed.sparkSession.createDataFrame(
        [(s[_RANGE], s["start"]) for s in kept],
        T.StructType([T.StructField(_RANGE, T.IntegerType()), sums.schema["start"]]),
    )
    return placed.join(F.broadcast(starts), _RANGE)


def ceil_rule(bins: int) -> Callable[[Column, Column], Column]:
    """Bucket of a running weight: its share times ``bins``, rounded up, within 1..bins."""

    def rule(running: Column, total: Column) -> Column:
        share = F.try_divide(running.cast("double"), total.cast("double"))
        return F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil(share * bins).cast("int")))

    return rule


def floor_rule(bins: int) -> Callable[[Column, Column], Column]:
    """Older bucket rule: share rounded to two digits, times ``bins``, rounded down, plus one."""

    def rule(running: Column, total: Column) -> Column:
        share = F.try_divide(running.cast("double"), total.cast("double"))
        share = F.rint(share * 100.0) / 100.0
        return F.least(F.lit(bins), F.floor(share * bins).cast("int") + 1)

    return rule


def weighted_buckets(
    df: DataFrame,
    order: Sequence[str],
    weight: Column,
    bins: int,
    rule: Callable[[int], Callable[[Column, Column], Column]] = ceil_rule,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Column:
    """Weighted quantile bucket of each row along ``order``; missing weights count as zero."""
    return crossings(df, order, weight, rule(bins), rows_per_range).level()


# --- brackets ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Brackets:
    """Stretches of a score, alternately without a step and with one inside.

    ``upto`` are the stretches' upper ends, the last one is open; ``inside`` says which may hold steps.
    """

    upto: tuple[float, ...]
    inside: tuple[int, ...]

    def stretch(self, score: Column) -> Column:
        out = F.lit(len(self.upto))
        for i in reversed(range(len(self.upto))):
            out = F.when(score <= self.upto[i], i).otherwise(out)
        return out


Rule = Callable[[Column, Column], Column]


def bracket_steps(
    df: DataFrame, score: str, weight: str, rule: Rule | Callable[[float], Rule], size: int, by_total: bool = False
) -> Brackets:
    """Stretches of ``score`` outside of which ``rule`` does not step.

    One read of ``df``: the rank bounds of a weighted summary say between which running weights the rows
    of each stretch lie.
    """
    found = summaries.summarise(df, [score], weight, size)[0]
    if not len(found):
        return Brackets((), ())
    total = float(found[-1, 3])
    if by_total:
        rule = rule(total)
    margin = 1e-9 * total  # of adding doubles
    before = np.maximum(np.concatenate([[0.0], found[:-1, 1] + found[:-1, 2]]) - margin, 0.0)
    upto = np.minimum(found[:, 3] + margin, total)
    spark = df.sparkSession
    spans = spark.createDataFrame(list(zip(range(len(found)), before.tolist(), upto.tolist())), "i int, a double, b double")
    steps = spans.select("i", (rule(F.col("a"), F.lit(total)) != rule(F.col("b"), F.lit(total))).alias("step"))
    step = np.zeros(len(found), dtype=bool)
    for r in steps.collect():  # one row per value of the summary
        step[r["i"]] = r["step"]
    ends = [i for i in range(len(found)) if i + 1 == len(found) or step[i] != step[i + 1]]
    values = [float(found[i, 0]) for i in ends]
    return Brackets(tuple(values), tuple(k for k, i in enumerate(ends) if step[i]))


def condensed(
    df: DataFrame,
    order: Sequence[str],
    score: Column,
    weight: Column,
    rule: Rule | Callable[[float], Rule],
    sums: Sequence[str] = (),
    size: int = summaries.SIZE,
    by_total: bool = False,
) -> DataFrame:
    """A small written table (row, w, least, sums) on which ``rule`` steps at the same rows as on ``df``.

    ``score`` must not decrease along ``order``. Two reads of ``df``: a summary brackets the steps, then one
    aggregate keeps the rows inside the brackets and adds up all others by stretch, each under its
    last row. With ``by_total``, ``rule`` is made from the total weight.
    """
    narrow = df.select(*order, *[c for c in sums if c not in order], weight.alias("__w"), score.cast("double").alias("__s"))
    narrow = narrow.withColumn("__w", zero_if_missing(narrow, "__w"))
    if isinstance(narrow.schema["__w"].dataType, (T.DoubleType, T.FloatType)):
        narrow = narrow.withColumn("__w", F.col("__w").cast(f"decimal(28,{WEIGHT_DIGITS})"))
    brackets = bracket_steps(narrow, "__s", "__w", rule, size, by_total)
    stretch = brackets.stretch(F.col("__s"))
    row = F.struct(*order)
    own = F.when(stretch.isin(*brackets.inside), row) if brackets.inside else F.lit(None).cast(narrow.select(row.alias("r")).schema["r"].dataType)
    added = narrow.groupBy(stretch.alias("stretch"), own.alias("own")).agg(
        F.max(row).alias("row"), F.sum("__w").alias("w"), F.min("__w").alias("least"), *[F.sum(c).alias(f"sum_{c}") for c in sums]
    )
    return stage(added.drop("stretch", "own"), "brackets")


def bucket_sums(
    df: DataFrame,
    order: Sequence[str],
    score: Column,
    weight: Column,
    bins: int,
    sums: Sequence[str],
    rule: Callable[[int], Callable[[Column, Column], Column]] = ceil_rule,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(bucket, sums): weighted quantile buckets along ``order`` and the sums of each.

    The same buckets as ``weighted_buckets``, from two reads of ``df``.
    """
    small = condensed(df, order, score, weight, rule(bins), sums)
    least = small.agg(F.min("least")).first()[0]
    if least is not None and least < 0:
        release(small)
        raise ValueError("weights must be >= 0")
    rows = small.select("row.*", "w", *[f"sum_{c}" for c in sums])
    bucket = crossings(rows, order, F.col("w"), rule(bins), rows_per_range).level()
    kinds = df.select(*[F.sum(c).alias(c) for c in sums]).schema
    found = rows.groupBy(bucket.alias("bucket")).agg(
        *[F.sum(f"sum_{c}").cast(kinds[c].dataType).alias(c) for c in sums]
    )
    out = df.sparkSession.createDataFrame(found.collect(), found.schema)  # one row per bucket
    release(small)
    return out


# --- smallest rows ----------------------------------------------------------------------------


def smallest(
    df: DataFrame, order: Sequence[str], n: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """The ``n`` first rows along ``order``.

    A plain ``limit`` after ``orderBy`` brings ``n`` rows of every input partition to one task. The
    first range of a large table holds about twice ``n`` rows, so the rest is filtered out first; if
    it holds too few, the ranges after it are taken in until there are enough.
    """
    ranges = split_ranges(df, order, max(2 * n, rows_per_range))
    for number in range(1, ranges.count):
        head = df.filter(ranges.here() < ranges.start_of(number))
        if head.count() >= n:
            return head.orderBy(*order).limit(n)
    return df.orderBy(*order).limit(n)


# --- order statistics -------------------------------------------------------------------------


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    rows_per_range: int = ROWS_PER_RANGE,
) -> list[float]:
    """Exact quantiles with linear interpolation, missing values left out.

    Ranks are bracketed by a summary, so only values near the wanted ones are sorted; two reads of ``df``.
    """
    col = missing_to_null(F.col(value), df.schema[value].dataType).cast("double")
    known = df.select(col.alias("v")).filter(F.col("v").isNotNull())
    spots: list[float] = []
    ranks: list[int] = []

    def rule(running: Column, total: Column) -> Column:
        wanted = F.array(*[F.lit(rank) for rank in ranks])
        return F.size(F.filter(wanted, lambda rank: rank <= running))

    def of_total(n: float) -> Callable[[Column, Column], Column]:
        spots[:] = [(n - 1) * p for p in probabilities]
        ranks[:] = sorted({int(r) + 1 for s in spots for r in (math.floor(s), math.ceil(s))})
        return rule

    small = condensed(known, ["v"], F.col("v"), F.lit(1).cast("long"), of_total, by_total=True)
    if not ranks:
        release(small)
        return [math.nan] * len(probabilities)
    found = crossings(small.select("row.v", "w"), ["v"], F.col("w"), rule, rows_per_range)
    release(small)
    value_at = {rank: found.at(i + 1)["v"] for i, rank in enumerate(ranks)}
    out = []
    for spot in spots:
        low, high = value_at[math.floor(spot) + 1], value_at[math.ceil(spot) + 1]
        out.append(low + (high - low) * (spot - math.floor(spot)))
    return out


# --- fills and slices -------------------------------------------------------------------------


def fill_forward(df: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """Carry the last known value of ``columns`` down a settings sheet of some dozen rows."""
    upto = Window.partitionBy().orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})


def first_positions(df: DataFrame, position: str, n: int) -> DataFrame:
    """Rows at positions 0..n-1."""
    return df.filter(F.col(position) < n)


def fill_from_below(
    grid: DataFrame, table: DataFrame, by: Sequence[str], on: str, value: str
) -> DataFrame:
    """Backward as-of join of ``table`` onto ``grid`` per group, then the group's least value above.

    Both sides must hold each (group, ``on``) pair at most once, so that the equi-join keeps the
    grid's rows and a group's window is no longer than its grid.
    """
    group = Window.partitionBy(*by)
    upto = group.orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(table.select(*by, on, value), [*by, on], "left")
    last = joined.withColumn(value, F.last(value, ignorenulls=True).over(upto))
    return last.withColumn(value, F.coalesce(F.col(value), F.min(value).over(group)))
