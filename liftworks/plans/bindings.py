"""The shared test tables seen as policy data.

Grain and key of every view are stated below; all are lazy. Losses are summed as whole units of
1/10000, so sums are exact, do not depend on the order of rows, and stay in plain longs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TRAIN_FOLDS = (1, 2, 3, 4, 5)
TEST_FOLD = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(name: str):
    return F.col(name).cast("decimal(18,2)")


def _hundredths(name: str):
    return F.rint(F.col(name) * 100).cast("bigint")


def aux(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order grain, key ``vin_date``: fold, target and depreciation factor."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("vin_date"),
        (F.col("o_orderkey") % 6 + 1).alias("fold"),
        F.col("o_totalprice").alias("pp"),
        "o_orderstatus",
        (1 - 0.05 * (F.col("o_orderkey") % 4)).alias("dep_factor"),
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line grain, key ``vin_date`` (repeats): line and part columns, text and gap columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("vin_date"),
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
        F.when(F.col("l_linenumber") == 7, "Unknown")
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("raw_num"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc_n"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_type", "p_name")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).drop("p_partkey")


def policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order grain, key ``o_orderkey``, orders with lines: exposure, losses and a tied score."""
    losses = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("bigint").alias("exposure"),
            F.sum(_hundredths("l_extendedprice") * _hundredths("l_discount")).alias("loss_units"),
        )
        .select(
            "l_orderkey",
            "exposure",
            (F.col("loss_units") * F.lit("0.0001").cast("decimal(4,4)"))
            .cast("decimal(24,4)")
            .alias("incurred_act"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    score = (F.floor(F.col("o_totalprice") / 1000) * 50).cast("bigint")
    return orders.join(losses, orders.o_orderkey == losses.l_orderkey).select(
        "o_orderkey",
        "o_orderstatus",
        (F.col("o_orderkey") % 6 + 1).alias("fold"),
        (F.col("o_orderkey") % 6 + 1 <= 5).alias("train"),
        "exposure",
        F.col("exposure").alias("denom"),
        "incurred_act",
        score.alias("pred"),
        (F.col("exposure") * score).alias("incurred_pred"),
        (1 + F.lit("0.05").cast("decimal(4,2)") * (F.col("o_orderkey") % 5))
        .cast("decimal(6,2)")
        .alias("offset_f"),
        F.col("o_totalprice").alias("cont"),
    )


def premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order grain, key ``o_orderkey``: earned premium, zero for pending orders."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,2)"))
        .otherwise(_money("o_totalprice"))
        .alias("ep"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order grain, key ``o_orderkey``: ordinal, boolean, continuous and text features."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    orders = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        (F.col("o_orderkey") % 6 + 1).alias("fold"),
        (F.col("o_orderkey") % 6).alias("lvl_a"),
        F.when(cust % 7 != 6, cust % 4).alias("lvl_b"),
        (cust % 2 == 0).alias("flag"),
        F.col("o_totalprice").alias("cont"),
        "c_mktsegment",
        "o_orderpriority",
        "o_orderstatus",
        "c_name",
    )


CONTRIB_FEATURES = ("lvl_a", "flag", "cont")


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order grain, key ``o_orderkey``: one contribution column per feature, and the weight.

    The contributions are whole hundredths over 100, so both engines see the same doubles.
    """
    weights = policy(spark, sf_dir).select("o_orderkey", F.col("exposure").alias("weight"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    hundredths = {
        "lvl_a": (F.col("o_orderkey") % 6 - 2) * 3,
        "flag": F.when(F.col("o_custkey") % 2 == 0, 10).otherwise(0),
        "cont": (F.floor(F.col("o_totalprice") / 50000) - 3) * 2,
    }
    return orders.join(weights, "o_orderkey").select(
        "o_orderkey",
        *[(c.cast("double") / 100.0).alias(n) for n, c in hundredths.items()],
        F.lit(0.5).alias("base_value"),
        "weight",
    )


def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature values that go with ``contributions``, as doubles."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        (F.col("o_orderkey") % 6).cast("double").alias("lvl_a"),
        (F.col("o_custkey") % 2 == 0).cast("double").alias("flag"),
        (F.floor(F.col("o_totalprice") / 20000) * 20000).cast("double").alias("cont"),
    )
