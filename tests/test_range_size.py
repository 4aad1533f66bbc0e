"""Results must not depend on how an order is cut into ranges."""

import datetime
import decimal
import math

import pytest
from pyspark.sql import functions as F

from liftworks.operators import evaluate as ev
from liftworks.operators import ordered

SIZES = (1, 4, 100, 10**6)


@pytest.fixture(scope="module")
def gaps(spark):
    """Ties, missing scores and actuals of both kinds, weights in tenths."""
    rows = [
        (
            k,
            None if k % 11 == 0 else math.nan if k % 13 == 0 else float(k * 7 % 17),
            None if k % 5 == 0 else math.nan if k % 9 == 0 else float(k % 4),
            (k % 6) * 0.1,
        )
        for k in range(1, 161)
    ]
    facts = "incurred_pred double, denom double"
    frame = spark.createDataFrame(rows, "k long, pred double, incurred_act double, w double")
    return frame.withColumns({"incurred_pred": F.lit(1.0), "denom": F.lit(1.0)}), facts


def test_gini_and_lorenz(gaps):
    frame, _ = gaps
    found = []
    for n in SIZES:
        gini = ev.gini(frame, "incurred_act", "pred", ["k"], n).first()
        curve = sorted(tuple(r) for r in ev.lorenz(frame, "incurred_act", "pred", ["k"], n).collect())
        assert all(None not in p and p[2] == p[2] for p in curve)
        found.append((gini["n"], round(gini["gini"], 12), [tuple(round(x, 12) for x in p) for p in curve]))
    assert all(f == found[0] for f in found)
    assert found[0][0] == 160 and len(found[0][2]) == 161


def test_lift_with_fractional_weights(gaps):
    frame, _ = gaps
    filled = frame.fillna(0.0, ["incurred_act"])
    tables = [
        sorted((r["decile"], round(r["w"], 9)) for r in ev.lift(filled, "w", "k", rows_per_range=n).collect())
        for n in SIZES
    ]
    assert all(t == tables[0] for t in tables) and len(tables[0]) == 10


def test_missing_scores_come_last(spark):
    frame = spark.createDataFrame(
        [(1, None), (2, math.nan), (3, 5.0), (4, 1.0)], "k long, pred double"
    ).withColumns({c: F.lit(1.0) for c in ("incurred_act", "incurred_pred", "denom", "w")})
    frame = frame.withColumn("incurred_act", F.col("k").cast("double"))
    rows = {r["decile"]: r["act"] for r in ev.lift(frame, "w", "k", bins=4).collect()}
    assert rows == {1: 4.0, 2: 3.0, 3: 1.0, 4: 2.0}


def test_order_columns_of_any_type(spark):
    base = datetime.datetime(2020, 1, 1, 3, 4, 5, 678901)
    kinds = {
        "decimal(12,3)": lambda k: decimal.Decimal(k * 37 % 101) / 8,
        "date": lambda k: (base + datetime.timedelta(days=k * 37 % 101)).date(),
        "timestamp": lambda k: base + datetime.timedelta(microseconds=k * 37 % 101),
        "float": lambda k: float(k * 37 % 101) / 3,
        "smallint": lambda k: k * 37 % 101,
        "boolean": lambda k: k % 3 == 0,
        "string": lambda k: f"é{k * 37 % 101}",
        "binary": lambda k: bytes([k * 37 % 101]),
    }
    for kind, value in kinds.items():
        rows = [(value(k) if k % 10 else None, k) for k in range(1, 120)]
        frame = spark.createDataFrame(rows, f"x {kind}, k long")
        got = [
            {r["k"]: r["at"] for r in ordered.running_totals(frame, ["x", "k"], {"at": F.lit(1)}, rows_per_range=n).collect()}
            for n in (7, 10**6)
        ]
        assert got[0] == got[1], kind
        assert ordered.smallest(frame.filter("x is not null"), ["x", "k"], 5, 10).count() == 5


def test_many_bounds_make_one_literal(spark):
    frame = spark.range(40_000).select((F.col("id") % 977).cast("decimal(10,2)").alias("x"), "id")
    ranges = ordered.split_ranges(frame, ["x", "id"], 20)
    assert ranges.count > 1000
    plan = ranges.assign(frame)._jdf.queryExecution().analyzed().toString()
    assert plan.count("named_struct") < 200


def test_small_fractions_are_told_apart(spark):
    from liftworks.operators import assemble as asm

    frame = spark.range(200_000)
    assert 2 <= asm.hash_sample(frame, "id", 0.00005).count() <= 25
    assert 15 <= asm.hash_sample(frame, "id", 0.00015).count() <= 50
    assert asm.hash_sample(frame, "id", 1.0).count() == 200_000


def test_left_joins_keep_rows_without_a_key(spark):
    from liftworks.operators import assemble as asm

    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 9), (None, 8)], "k string, y int")
    got = sorted((r["x"], r["y"]) for r in asm.join_new_columns(left, right, "k").collect())
    assert got == [(1, None), (2, None), (3, 9)]
