import math

import pytest
from pyspark.sql import functions as F

from liftworks import sources
from liftworks.operators import assemble as asm
from liftworks.operators import catalog as cat
from liftworks.operators import condition as con
from liftworks.operators import settings as st
from liftworks.sources.files import predictions


def names(df, column="column_name"):
    return sorted(r[column] for r in df.collect())


# --- sources ---


def test_sinks_and_scans(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k bigint, s string, fold int")
    sources.write_parquet(df, f"{tmp_path}/p", ["fold"])
    pruned = sources.read_parquet(spark, f"{tmp_path}/p", ["s", "absent"], always=["k"])
    assert pruned.columns == ["s", "k"] and pruned.count() == 2
    assert sorted(sources.read_parquet(spark, f"{tmp_path}/p").columns) == ["fold", "k", "s"]
    sources.write_csv(df, f"{tmp_path}/csv_CAR")
    got = sources.read_csv(spark, f"{tmp_path}/csv_{{veh_type}}", "k bigint, s string, fold int", veh_type="CAR")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (2, "b", 2)]
    sources.write_metrics(df.limit(1), f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").count() == 1
    assert predictions(df.withColumn("pred", F.lit(1.0)), "k", "s").columns == ["k", "pred", "s"]


def test_metadata_csv_skips_comments(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("# title\n#\ncolumn_name,notes\na,first\n# between\nb,second\n")
    rows = sources.read_metadata_csv(spark, str(tmp_path / "sheet.csv")).collect()
    assert [r["column_name"] for r in rows] == ["a", "b"]


def test_stage_reads_back(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("double"))
    staged = sources.stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString() and staged.count() == 10
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()


# --- catalog ---


def test_schema_export_names_types(spark):
    df = spark.createDataFrame([], "a bigint, b double, c string, d decimal(5,0), e timestamp, f boolean")
    rows = {r["column_name"]: r["dtype"] for r in cat.export_schema(df).collect()}
    assert rows == {
        "a": "int64", "b": "double", "c": "string", "d": "decimal128(5, 0)", "e": "timestamp[us]", "f": "bool",
    }
    assert cat.type_distribution(cat.export_schema(df)).count() == 6


def test_load_plan_reports_what_is_missing(spark):
    catalog = spark.createDataFrame([("k", "", ""), ("a", "", ""), ("b", "", "")], "column_name string, dtype string, notes string")
    sheet = spark.createDataFrame([("a",), ("z",)], "column_name string")
    plan, absent = cat.load_plan(catalog, sheet, ["k", "vin"])
    assert {(r["column_name"], r["source"]) for r in plan.collect()} == {("k", "essential"), ("a", "feature")}
    assert names(absent) == ["vin", "z"]
    row = cat.load_reduction(catalog, plan).first()
    assert (row["total"], row["loaded"], row["skipped"]) == (3, 2, 1)


def test_leakage_scan(spark):
    columns = ["Claim_count", "ee_bi", "pp_x", "speed", "Loss_ratio", "ee_new"]
    catalog = spark.createDataFrame([(c, "", "") for c in columns], "column_name string, dtype string, notes string")
    known = spark.createDataFrame([(t,) for t in sorted(cat.always_excluded(["pp_x"]))], "column_name string")
    rows = {r["column_name"]: r for r in cat.leakage_scan(catalog, known).collect()}
    assert set(rows) == {"Claim_count", "ee_bi", "pp_x", "Loss_ratio", "ee_new"}
    assert not rows["ee_bi"]["leaker"] and not rows["pp_x"]["leaker"] and rows["pp_x"]["csv_row"] is None
    assert rows["Claim_count"]["pattern"] == "claim"
    assert rows["ee_new"]["csv_row"] == "ee_new,data_leakage,leakage"


def test_column_selection(spark):
    df = spark.createDataFrame([], "vc_a int, vc_b string, vc_flag boolean, num_coll double, k bigint")
    assert cat.numeric_columns(df, ["k"]) == ["vc_a", "num_coll"]
    assert cat.text_columns(df) == ["vc_b"]
    assert cat.boolean_columns(df) == ["vc_flag"]
    assert cat.included(df.columns, ["k", "zz", "vc_a"]) == ["k", "vc_a"]
    assert cat.included(df.columns, None) == df.columns
    facts, features = cat.facts_and_features(df.columns, ["_liab", "_coll"], ["k"])
    assert facts == ["num_coll"] and features == ["vc_a", "vc_b", "vc_flag"]
    assert [tuple(r) for r in cat.feature_list(df, "vc_").collect()] == [("vc_a", 0, 0), ("vc_b", 0, 0), ("vc_flag", 0, 0)]


# --- assembly ---


def test_assemble_renames_overlaps_and_drops_null_keys(spark):
    master = spark.createDataFrame([("a", 1, 5), (None, 2, 6), ("a", 3, 7)], "vindate string, st int, m int")
    aux = spark.createDataFrame([("a", 9, 1), (None, 8, 1)], "vin_date string, st int, fold int")
    got = asm.assemble(master, aux, "vin_date")
    assert got.columns == ["vin_date", "st_x", "m", "st_y", "fold"]
    assert sorted(r["m"] for r in got.collect()) == [5, 7]
    with pytest.raises(ValueError):
        asm.resolve_key(["x"], "vin_date")
    with pytest.raises(ValueError):
        asm.fold_filter(master, [1])


def test_folds():
    assert asm.folds_for(2, {1: [1], 2: [1, 2]}, 6) == [1, 2, 6]


def test_new_columns_only(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "k int, x int")
    b = spark.createDataFrame([(1, 9, 7)], "k int, x int, y int")
    assert sorted(map(tuple, asm.join_new_columns(a, b, "k").select("k", "x", F.coalesce("y", F.lit(0))).collect())) == [(1, 1, 7), (2, 2, 0)]


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    for sample in (lambda d: asm.hash_sample(d, "k", 0.2), lambda d: asm.fixed_sample(d, "k", 100)):
        a, b = (sorted(r["k"] for r in sample(d).collect()) for d in (df.repartition(3), df.repartition(11)))
        assert a == b
    assert abs(asm.hash_sample(df, "k", 0.2).count() - 1000) < 150
    assert asm.fixed_sample(df, "k", 100).count() == 100
    small, ranged = (
        sorted(r["k"] for r in asm.fixed_sample(df, "k", 100, rows_per_range=n).collect()) for n in (10_000, 500)
    )
    assert small == ranged
    assert asm.fixed_sample(df, "k", 10_000).count() == 5000
    assert sorted(r["k"] for r in asm.first_rows(df, "k", 3).collect()) == [0, 1, 2]


def test_load_modes(spark):
    df = spark.createDataFrame(
        [(i, None if i % 2 else float(i), "5" if i % 3 else "Unknown", i * 10**10) for i in range(1000)],
        "k bigint, y double, model_year_raw string, big bigint",
    )
    full = asm.load(df, "y", "k", numeric_text=["model_year_raw", "absent"])
    assert full.count() == 500
    assert full.schema.simpleString() == "struct<k:bigint,y:float,model_year_raw:float,big:bigint>"
    assert asm.load(df, "y", "k", "first", n=10).count() == 5
    assert 20 < asm.load(df, "y", "k", "fraction").count() < 80
    with pytest.raises(ValueError):
        asm.load(df, "y", "k", "some")


# --- conditioning ---


def test_cap_applies_to_listed_targets(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,), (math.nan,)], "pp double")
    capped = [r[0] for r in con.cap_target(df, "pp", 5, ["pp"]).collect()]
    assert capped[:3] == [1.0, 5.0, None] and math.isnan(capped[3])
    assert con.cap_target(df, "pp", 5, ["other"]).filter("pp = 9").count() == 1
    row = con.cap_report(df, "pp", 5).first()
    assert (row["capped_rows"], row["capped_pct"]) == (1, 25.0)


def test_conversion_rate_counts_all_rows(spark):
    df = spark.createDataFrame([("1", "1"), ("2", None), ("x", None), ("3", None)], "a string, b string")
    rows = con.detect_conversions(df).collect()
    assert [(r["column_name"], r["success_rate"]) for r in rows] == [("a", 0.75)]


def test_coerce_listed_text_only(spark):
    df = spark.createDataFrame([("1", "2", 3)], "DrvAge_raw string, other string, late_payments_raw int")
    assert dict(con.coerce_numeric(df).dtypes) == {"DrvAge_raw": "double", "other": "string", "late_payments_raw": "int"}


def test_blanking(spark):
    df = spark.createDataFrame(
        [(2.0, True, 5), (1.0, False, 5), (1.0, True, 6), (2.0, True, 6), (math.nan, True, 7), (math.nan, True, 7), (math.nan, True, 8)],
        "x double, b boolean, n int",
    )
    assert con.modes(df, ["x", "n"]) == {"x": 1.0, "n": 5}
    row = con.blank_out(df, ["x", "b", "n", "absent"], non_boolean=["x"]).distinct().collect()
    assert [tuple(r) for r in row] == [(1.0, False, 0)]


def test_mode_reads_a_hot_value_from_partial_counts(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    assert con.modes(df, ["v"]) == {"v": 7}


def test_missing_profile_and_fill(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (math.nan, 2, None), (None, 3, "b"), (4.0, 4, "c")], "x double, n int, s string")
    rows = {r["column_name"]: (r["missing"], r["missing_pct"]) for r in con.missing_profile(df).collect()}
    assert rows == {"x": (2, 50.0), "n": (1, 25.0), "s": (1, 25.0)}
    filled = con.fill_missing(df)
    assert sorted(r["x"] for r in filled.collect()) == [0.0, 0.0, 1.0, 4.0]
    assert filled.filter("s is null").count() == 1
    assert con.has_value(df, "x").count() == 2


def test_derivations(spark):
    df = spark.createDataFrame([(2.0, 3.0, 4.0, 5.0)], "a double, b double, c double, loss double")
    row = con.derive_offset(df, ["a", "b", "c"], "loss", "offset_all").first()
    assert (row["offset_all"], row["incurred_act_capped"]) == (24.0, 120.0)
    out = con.keep_selected(con.drop_if_present(con.constant_columns(df, ["z"]), ["a", "no"]), ["loss"], ["z", "no"])
    assert out.columns == ["loss", "z"] and out.first()["z"] == 0


def test_model_prep_keeps_missing_groups_apart(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 1), (0, 2.0, 1), (None, 5.0, 2), (1, -1.0, 1), (2, 1.0, 0)], "f int, num double, w int"
    )
    rows = con.model_prep(df, ["f"], "num", "w", "w", aggregate=True).collect()
    assert sorted((r["f"], r["num"], r["w"], r["target"]) for r in rows) == [(0, 3.0, 2, 1.5), (0, 5.0, 2, 2.5)]
    assert con.model_prep(df, ["f"], "num", "w", "w").count() == 3


def test_target_statistics(spark):
    df = spark.createDataFrame([(x, 1) for x in (1.0, 2.0, 3.0, 10.0, None, math.nan)], "y double, fold int")
    row = con.target_stats(df, "y").first()
    assert (row["n"], row["mean"], row["median"], row["min"], row["max"]) == (4, 4.0, 2.5, 1.0, 10.0)
    with pytest.raises(ValueError):
        con.target_stats(df, "absent")
    report = {(r["section"], r["name"]): r["value"] for r in con.verification_report(df, "y").collect()}
    assert report[("shape", "rows")] == 6 and report[("fold", "1")] == 6 and report[("target", "max")] == 10.0


# --- settings ---


def test_settings_sheet(spark):
    sheet = spark.createDataFrame(
        [
            (0, "CAR", "coll", "mono", "1", "x", None), (1, None, None, "low_clip", "2", "3", None),
            (2, None, None, "high_clip", "8", "9", "4"), (3, "VAN", None, "mono", "-1", "1", "1"),
            (4, "-", None, "mono", "0", "0", "0"), (5, "CAR", "coll", "mono", "7", "7", "7"),
        ],
        "pos int, veh_type string, cov string, category string, vc_a string, vc_b string, vc_gone string",
    )
    catalog = spark.createDataFrame([("vc_a", "double", ""), ("vc_b", "bool", "")], "column_name string, dtype string, notes string")
    table = st.reshape_settings(sheet, catalog, "CAR", "coll", rows=5)
    rows = {r["field"]: (r["mono"], r["low_clip"], r["high_clip"], r["dtype"]) for r in table.collect()}
    assert rows == {"vc_a": ("1", "2", "8", "double"), "vc_b": ("x", "3", "9", "bool")}
    assert [tuple(r) for r in st.blanked(table).collect()] == [("vc_b", "bool")]
    rules = con.clip_rules(table.filter("mono != 'x'"), "field", "low_clip", "high_clip")
    assert rules == {"vc_a": (2.0, 8.0)}

    options = spark.createDataFrame(
        [("vc_b", "-1", "CAR"), ("vc_c", "1", "CAR"), ("vc_a", "0", "VAN")], "field string, mono string, vc_Vehicle_Type_M string"
    )
    listed = catalog.union(spark.createDataFrame([("vc_c", "double", "")], catalog.schema))
    options = st.option_settings(options, "CAR", listed)
    assert names(options, "field") == ["vc_b", "vc_c"]
    mono = st.monotone_directions(spark, ["vc_a", "vc_b", "vc_c", "vc_d"], table, options)
    assert {r["field"]: r["mono"] for r in mono.collect()} == {"vc_a": 1, "vc_b": 0, "vc_c": 1, "vc_d": 0}
    mono = st.monotone_directions(spark, ["vc_a", "vc_d"], table, options, unlisted=None)
    assert names(mono, "field") == ["vc_a"]
    text = st.constraint_text(st.monotone_directions(spark, ["vc_c", "vc_a", "vc_b"], table, options), ["vc_b", "vc_a", "vc_c"])
    assert text.first()["constraints"] == "(0, 1, 1)"


def test_metadata_in_parts(spark, tmp_path):
    lines = spark.range(0, 40, 1, 4).select(F.concat(F.lit("# a\n"), "id", F.lit(",x")).alias("v"))
    lines.write.text(f"{tmp_path}/sheet")
    got = sources.read_metadata_csv(spark, f"{tmp_path}/sheet", ["n", "kind"])
    assert got.dtypes == [("n", "string"), ("kind", "string")] and got.rdd.getNumPartitions() >= 1
    assert sorted(int(r["n"]) for r in got.collect()) == list(range(40))


def test_reports_have_a_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources.files, "REPORT_ROWS", 30)
    sources.write_csv(spark.range(30), f"{tmp_path}/fits")
    assert len(list((tmp_path / "fits").glob("part-*"))) == 1
    assert spark.read.csv(f"{tmp_path}/fits", header=True).count() == 30
    with pytest.raises(Exception, match="at most 30 rows"):
        sources.write_csv(spark.range(31), f"{tmp_path}/over")
