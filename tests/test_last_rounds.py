"""Boosting on few tasks: rows arrive packed, and margins no round needs are not written."""

import numpy as np
import pyarrow as pa
import pytest

from liftworks.operators import boosting, model as md


def table(spark, n):
    rows = [(float(i % 7), None if i % 11 == 0 else float(i % 5), 1.0 + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, y double").repartition(3)


@pytest.mark.parametrize("tasks", [0, 1])
def test_margins_of_the_last_rounds_are_not_written(spark, monkeypatch, tasks):
    staged = []
    stage = boosting.stage

    def seen(df, label="frame", *rest):
        out = stage(df, label, *rest)
        staged.append((label, out.count()))
        return out

    monkeypatch.setattr(boosting, "stage", seen)
    options = dict(label="y", rounds=3, max_depth=2, tasks=tasks, stage_every=2, keep_every=2)
    fitted = md.fit_boosted(table(spark, 400), ["a", "b"], **options)
    assert len(fitted.trees) == 3
    # two rounds with the rows for the third, then trees alone
    assert staged == [("boosting", 401), ("boosting", 1)]


def test_packed_rows_come_back():
    rng = np.random.default_rng(2)
    rows = boosting.Rows([], 3)
    rows.margin, rows.label, rows.weight = rng.normal(size=(3, 25))
    rows.mark = rng.integers(-(2**63), 2**63, 25)
    rows.bins = rng.integers(0, 256, (3, 25)).astype(np.uint8)
    packed = list(boosting._packed(rows.batches(10)))
    assert [b.num_rows for b in packed] == [1, 1, 1]
    again = boosting.Rows.unpacked(packed, 3)
    for name in ("margin", "label", "weight", "mark", "bins"):
        assert (getattr(again, name) == getattr(rows, name)).all()
    assert not len(boosting.Rows.unpacked([], 3).margin)
    assert isinstance(packed[0], pa.RecordBatch)
