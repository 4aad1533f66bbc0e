import math

import pytest

from liftworks.operators import encode as enc


@pytest.fixture(scope="module")
def train(spark):
    rows = [
        (i, i % 6, None if i % 9 == 0 else i % 3, float(i), ["a", "b", None][i % 3], f"name{i:04d}", "x%d" % (i % 2))
        for i in range(300)
    ]
    return spark.createDataFrame(
        rows, "k bigint, lvl int, part int, cont double, txt string, many string, two string"
    ).cache()


def test_detector_goldens(spark):
    rows = [(0.0, 1.0, None, 0.0), (0.5, 1.0, math.nan, 6.0), (5.0, 1.0, None, 6.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {r["field"]: r["is_ordinal"] for r in enc.detect_ordinal(df, df.columns).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False}
    assert enc.detect_ordinal(df, []).count() == 0


def test_detector_counts_distinct_values(spark):
    df = spark.createDataFrame([(i / 8,) for i in range(9)], "a double")
    assert [r["is_ordinal"] for r in enc.detect_ordinal(df, ["a"]).collect()] == [False]


def test_guard(spark, train):
    got = {r["field"]: (r["n_unique"], r["safe"]) for r in enc.cardinality(train, ["txt", "many"]).collect()}
    assert got == {"txt": (2, True), "many": (300, False)}
    assert set(enc.fit_categories(train, ["txt", "many"])) == {"txt"}
    assert enc.fit_categories(train, ["txt"]) == {"txt": ["a", "b", "nan"]}


def test_guard_is_exact_at_the_limit(spark):
    df = spark.createDataFrame([(f"v{i:03d}", f"w{min(i, 99):03d}") for i in range(101)], "a string, b string")
    assert set(enc.fit_categories(df, ["a", "b"])) == {"b"}


def test_ordinal(train):
    state = enc.fit_encoder(train, "ordinal", exclude=["k"], on_wide="drop")
    assert state.feature_names == ["lvl", "part", "cont", "txt__a", "txt__b", "txt__nan", "two__x0", "two__x1"]
    assert state.skipped == ("many",)
    got = state.transform(train, keep=["k"])
    assert set(dict(got.dtypes).values()) == {"bigint", "float"}
    for r in got.collect():
        assert r["txt__a"] + r["txt__b"] + r["txt__nan"] == 1.0


def test_unseen_level_is_all_zeros(spark, train):
    state = enc.fit_encoder(train, "ordinal", exclude=["k"], on_wide="drop")
    other = spark.createDataFrame([(1, 1, 1, 1.0, "zz", "n", "x9")], train.schema)
    row = state.transform(other).first()
    assert [row[c] for c in ("txt__a", "txt__b", "txt__nan", "two__x0", "two__x1")] == [0.0] * 5


def test_binary_and_custom(train):
    binary = enc.fit_encoder(train, "binary", exclude=["k"], on_wide="drop").transform(train, ["k"]).orderBy("k").collect()
    custom = enc.fit_encoder(train, "custom", exclude=["k"], on_wide="drop").transform(train, ["k"]).orderBy("k").collect()
    assert [r["lvl"] for r in binary[:6]] == [0, 0, 0, 1, 1, 1]
    assert [r["lvl"] for r in custom[:6]] == [0, 0, 0, 1, 0, 1]
    assert binary[0]["part"] is None and binary[9]["part"] is None
    assert binary[7]["cont"] == 7.0


def test_ordinal_columns_are_decided_on_training_rows(spark, train):
    state = enc.fit_encoder(train, "binary", exclude=["k"], on_wide="drop")
    other = spark.createDataFrame([(1, 900, 1, 1.0, "a", "n", "x0")], train.schema)
    assert state.transform(other).first()["lvl"] == 0.0


def test_mapped_strategies(train):
    mapping = {
        "lvl": "ohe_map2to4", "part": "h_map2to4", "cont": "drop", "txt": "not_specified", "many": "ordered", "two": "group_ohe",
    }
    state = enc.fit_encoder(train, "mapped", mapping, exclude=["k"])
    rows = state.transform(train, ["k"]).orderBy("k").collect()
    assert "cont" not in rows[0].asDict()
    assert rows[2]["lvl__4.0"] == 1.0 and rows[4]["lvl__4.0"] == 1.0 and "lvl__2.0" not in rows[0].asDict()
    assert [r["part"] for r in rows[:6]] == [None, 1.0, 4.0, 0.0, 1.0, 4.0]
    assert [r["txt"] for r in rows[:3]] == [0.0, 1.0, -1.0]
    assert [r["many"] for r in rows] == [float(i) for i in range(300)]
    assert rows[0]["two__x0"] == 1.0


def test_label_table_for_unseen(spark, train):
    state = enc.fit_encoder(train, "mapped", {}, exclude=["k"])
    other = spark.createDataFrame([(1, 1, 1, 1.0, "zz", "n", "x0")], train.schema)
    row = state.transform(other).first()
    assert row["txt"] == -1.0 and row["many"] == -1.0


def test_mapped_guard_and_whitelist(train):
    state = enc.fit_encoder(train, "mapped", {"many": "ohe"}, include=["lvl", "txt"], exclude=["k"], on_wide="drop")
    assert state.skipped == ("many",) and state.feature_names == ["lvl", "txt"]
    assert state.transform(train).columns == ["lvl", "txt"]


def test_bad_names_are_refused(train):
    with pytest.raises(ValueError):
        enc.fit_encoder(train, "other")
    with pytest.raises(ValueError):
        enc.fit_encoder(train, "mapped", {"lvl": "unknown"})


def test_transform_is_one_projection(train):
    plan = enc.fit_encoder(train, "binary", exclude=["k"], on_wide="drop").transform(train)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
