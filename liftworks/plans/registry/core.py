"""Registration of named queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from liftworks.functions import round_digits

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tidy(df: DataFrame, digits: int | Mapping[str, int] = 6) -> DataFrame:
    """Decimals to double and doubles to a fixed number of digits, for comparison across engines."""

    def out(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            n = digits if isinstance(digits, int) else digits.get(field.name, 6)
            return round_digits(col, n).alias(field.name)
        return col

    return df.select(*[out(f) for f in df.schema])


def r6(expr: str) -> str:
    """SQL text of the same rounding."""
    return f"(round_even(CAST({expr} AS DOUBLE) * 1000000.0, 0) / 1000000.0)"


POLICY_SQL = """
losses AS (
  SELECT l_orderkey,
         CAST(sum(l_quantity) AS BIGINT) AS exposure,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)))
              AS DECIMAL(24,4)) AS incurred_act
  FROM lineitem GROUP BY l_orderkey),
policy AS (
  SELECT o_orderkey, o_orderstatus, o_orderkey % 6 + 1 AS fold, o_orderkey % 6 + 1 <= 5 AS train,
         exposure, exposure AS denom, incurred_act,
         CAST(floor(o_totalprice / 1000) * 50 AS BIGINT) AS pred,
         exposure * CAST(floor(o_totalprice / 1000) * 50 AS BIGINT) AS incurred_pred,
         CAST(1 + CAST(0.05 AS DECIMAL(4,2)) * (o_orderkey % 5) AS DECIMAL(6,2)) AS offset_f,
         o_totalprice AS cont
  FROM orders JOIN losses ON o_orderkey = l_orderkey)"""

AUX_SQL = """
aux AS (
  SELECT o_orderkey AS vin_date, o_orderkey % 6 + 1 AS fold, o_totalprice AS pp, o_orderstatus,
         1 - 0.05::DOUBLE * (o_orderkey % 4) AS dep_factor
  FROM orders)"""

MASTER_SQL = """
master AS (
  SELECT l_orderkey AS vin_date, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus,
         CASE WHEN l_linenumber = 7 THEN 'Unknown'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS raw_num,
         nullif(l_discount, 0.0) AS disc_n, p_size, p_brand, p_type, p_name
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PREMIUM_SQL = """
premium AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DECIMAL(18,2))
                          ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS ep
  FROM orders)"""

FEATURES_SQL = """
features AS (
  SELECT o_orderkey, o_orderkey % 6 + 1 AS fold, o_orderkey % 6 AS lvl_a,
         CASE WHEN o_custkey % 7 <> 6 THEN o_custkey % 4 END AS lvl_b,
         o_custkey % 2 = 0 AS flag, o_totalprice AS cont,
         c_mktsegment, o_orderpriority, o_orderstatus, c_name
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CONTRIB_SQL = """
contrib AS (
  SELECT o_orderkey,
         CAST((o_orderkey % 6 - 2) * 3 AS DOUBLE) / 100.0 AS lvl_a,
         CASE WHEN o_custkey % 2 = 0 THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END / 100.0 AS flag,
         CAST((floor(o_totalprice / 50000) - 3) * 2 AS DOUBLE) / 100.0 AS cont,
         exposure AS weight
  FROM orders JOIN policy USING (o_orderkey)),
explained AS (
  SELECT o_orderkey, CAST(o_orderkey % 6 AS DOUBLE) AS lvl_a,
         CAST(o_custkey % 2 = 0 AS DOUBLE) AS flag,
         CAST(floor(o_totalprice / 20000) * 20000 AS DOUBLE) AS cont
  FROM orders),
long AS (
  SELECT o_orderkey, 'lvl_a' AS field, e.lvl_a AS val, c.lvl_a AS contrib, weight
  FROM contrib c JOIN explained e USING (o_orderkey)
  UNION ALL
  SELECT o_orderkey, 'flag', e.flag, c.flag, weight
  FROM contrib c JOIN explained e USING (o_orderkey)
  UNION ALL
  SELECT o_orderkey, 'cont', e.cont, c.cont, weight
  FROM contrib c JOIN explained e USING (o_orderkey))"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)
