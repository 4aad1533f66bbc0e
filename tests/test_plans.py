"""Physical plans: what reaches the scan, and what is shuffled."""

from pyspark.sql import functions as F

from liftworks.operators import assemble as asm
from liftworks.operators import condition as con
from liftworks.operators import evaluate as ev
from liftworks.operators import explain as ex
from liftworks.operators import ordered
from liftworks.plans import bindings as b
from liftworks.sources import read_parquet, stage

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def test_scan_is_pruned_and_filter_pushed(spark):
    df = read_parquet(spark, f"{SF}/orders.parquet", ["o_totalprice"], always=["o_orderkey"])
    text = plan(asm.first_rows(df.filter(F.col("o_orderkey") < 50), "o_orderkey", 10))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "LessThan(o_orderkey,50)" in text


def test_fold_filter_prunes_partitions(spark, tmp_path):
    b.aux(spark, SF).write.partitionBy("fold").parquet(f"{tmp_path}/aux")
    df = asm.fold_filter(spark.read.parquet(f"{tmp_path}/aux"), [1, 6])
    assert "PartitionFilters: [fold" in plan(df)


def test_fold_filter_reaches_the_scan_below_the_join(spark, tmp_path):
    stored = stage(b.aux(spark, SF), "aux")
    text = plan(asm.assemble(b.master(spark, SF), asm.fold_filter(stored, [1, 6]), "vin_date"))
    assert "In(fold, [1,6])" in text


def test_lift_shuffles_bucket_sums_only(spark, monkeypatch):
    df = stage(b.policy(spark, SF), "policy")
    written = []
    monkeypatch.setattr(ordered, "stage", lambda d, *a, **k: written.append(plan(d)) or stage(d, *a, **k))
    lift = ev.lift(df, "exposure", "o_orderkey")
    # the rows are added up before the one exchange of the table that brackets the borders
    assert len(written) == 1
    head = written[0].split("(1)")[0]
    assert head.count("Exchange") == 1 and "partial_sum" in written[0]
    # what is left reads a row per bucket, one exchange for the totals over them
    head = plan(lift).split("(1)")[0]
    assert head.count("Sort") == 0 and head.count("Exchange") == 1 and "parquet" not in head
    assert lift.count() == 10


def test_totals_per_feature_need_no_unpivot_of_rows(spark):
    text = plan(ex.contrib_totals(b.contributions(spark, SF), b.CONTRIB_FEATURES, "weight"))
    last = text.index("partial_sum(abs") if "partial_sum(abs" in text else text.index("partial_sum((abs")
    assert last > 0 and "Generate" not in text.split("(1)")[0]


def test_profiles_are_one_aggregate(spark):
    text = plan(con.missing_profile(b.table(spark, SF, "lineitem"))).split("(1)")[0]
    assert text.count("Scan parquet") == 1 and text.count("Exchange") == 1


def test_level_tables_combine_before_the_shuffle(spark):
    long = ex.long_contributions(
        b.contributions(spark, SF), b.explained(spark, SF), b.CONTRIB_FEATURES, "o_orderkey", "weight"
    )
    text = plan(ex.contrib_value_table(long))
    assert "partial_sum(weight" in text
