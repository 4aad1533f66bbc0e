"""Column profiles: exact up to the guard, estimates above, nothing that grows with distinct values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.operators import profiles as pf


@pytest.mark.parametrize("n", [1, 90, 3000, 20_000, 400_000])
def test_estimates_keep_their_error(n):
    rng = np.random.default_rng(n)
    off = [pf.estimate(pf.registers_of(rng.integers(-(2**63), 2**63 - 1, n))) / n - 1 for _ in range(5)]
    assert np.abs(off).max() < 4 * 1.04 / 64 and abs(np.mean(off)) < 0.03


def test_profiles_equal_plain_counts(spark):
    df = spark.range(0, 40_000, 1, 9).select(
        (F.col("id") % 7).cast("double").alias("few"),
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 5 == 1, None).otherwise(F.col("id") % 8 - 2.0).alias("gaps"),
        (F.col("id") / 3.0).alias("many"),
        F.concat(F.lit("t"), F.col("id") % 100).alias("limit"),
        F.concat(F.lit("t"), F.col("id") % 101).alias("over"),
        F.when(F.col("id") < 0, "x").alias("none"),
    )
    numbers = {c: F.col(c) for c in ("few", "gaps", "many")}
    texts = {c: F.col(c) for c in ("limit", "over", "none")}
    out = pf.profile(df, numbers, texts, 8, 100)
    assert out["few"] == pf.Profile(tuple(map(float, range(7))), 7.0, 0.0, 6.0)
    assert out["gaps"].values == tuple(float(x) for x in range(-2, 6)) and (out["gaps"].lo, out["gaps"].hi) == (-2, 5)
    assert out["many"].values is None and abs(out["many"].distinct / 40_000 - 1) < 0.065 and out["many"].hi == 39_999 / 3
    assert len(out["limit"].values) == 100 and out["limit"].values == tuple(sorted(out["limit"].values))
    assert out["over"].values is None and abs(out["over"].distinct - 101) < 7
    assert out["none"] == pf.Profile((), 0.0)
    assert pf.profile(df, {}, {}, 1, 1) == {}
    empty = pf.profile(df.filter("id < 0") if "id" in df.columns else df.limit(0), numbers, texts, 8, 100)
    assert all(p.values == () and p.distinct == 0 for p in empty.values())


def test_one_read_and_one_row_per_task_and_column(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 30_000, 1, 6).select(F.col("id").cast("string").alias("t"), F.col("id").cast("double").alias("x"))
    pf.profile(df.mapInArrow(count, df.schema), {"x": F.col("x")}, {"t": F.col("t")}, 7, 100)
    assert seen.value == 30_000
