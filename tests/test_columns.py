import math

import pytest
from pyspark.sql import functions as F

from liftworks import functions as fn


def values(spark, rows, column, schema="x double"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_binary_map(spark):
    got = values(spark, [0.0, 2.0, 3.0, 5.0, 7.0, None, math.nan], lambda c: fn.binary_map(c, {0, 1, 2}, {3, 4, 5}))
    assert got == [0, 0, 1, 1, 0, None, None]


def test_binary_map_rounds_half_to_even(spark):
    got = values(spark, [2.5, 3.5], lambda c: fn.binary_map(c, {0, 1, 2}, {3, 4, 5}))
    assert got == [0, 1]


def test_custom_levels(spark):
    def custom(c):
        return fn.binary_map(fn.remap_level(c, 2, 4), {0, 1, 4}, {3, 5})

    assert values(spark, [0, 1, 2, 3, 4, 5], custom, "x int") == [0, 0, 0, 1, 0, 1]


def test_remap_keeps_others_and_missing(spark):
    got = values(spark, [2.0, 1.5, None, math.nan, 2.4], lambda c: fn.remap_level(c, 2, 4))
    assert got[:2] == [4.0, 4.0] and got[2:4] == [None, None] and got[4] == 4.0


def test_rounding_is_half_even_on_the_binary_value(spark):
    assert values(spark, [0.575, 2.5, 0.125], lambda c: fn.round_digits(c, 2)) == [0.57, 2.5, 0.12]
    assert values(spark, [2.5, 3.5], lambda c: fn.round_digits(c, 0)) == [2.0, 4.0]
    assert values(spark, [7.0, 13.0], lambda c: fn.round_step(c, 5)) == [5.0, 15.0]
    assert values(spark, [7.3], lambda c: fn.round_step(c, 0)) == [7.3]


def test_clip_lets_missing_through(spark):
    got = values(spark, [1.0, 9.0, None, math.nan, 3.0], lambda c: fn.clip(c, 2, 5))
    assert got[:3] == [2.0, 5.0, None] and math.isnan(got[3]) and got[4] == 3.0


def test_numbers_from_text(spark):
    texts = ["1", " 2.5 ", "Unknown", "", None, "-1e3", ".5", "5-LOW", "1d", "inf", "1.", "0x1", "1 2", "nan"]
    got = values(spark, texts, fn.to_number, "x string")
    assert got == [1.0, 2.5, None, None, None, -1000.0, 0.5, None, None, math.inf, 1.0, None, None, None]


def test_label_codes(spark):
    got = values(spark, ["b", None, "z", "a"], lambda c: fn.label_code(c, ["a", "b"]), "x string")
    assert got == [1, -1, -1, 0]


def test_one_hot_unseen_and_missing(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    rows = df.select(*fn.one_hot(F.col("x"), "x", ["a", "nan"])).collect()
    assert [tuple(r) for r in rows] == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    assert rows[0].asDict().keys() == {"x__a", "x__nan"}


def test_missing_is_null_or_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,)], "x double")
    assert df.filter(fn.is_missing(F.col("x"), df.schema["x"].dataType)).count() == 2


@pytest.mark.parametrize("part, whole, want", [(1.0, 4.0, 25.0), (1.0, 0.0, None)])
def test_per_hundred(spark, part, whole, want):
    df = spark.createDataFrame([(part, whole)], "a double, b double")
    assert df.select(fn.per_hundred(F.col("a"), F.col("b"))).first()[0] == want
