"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_parquet(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    always: Sequence[str] = (),
) -> DataFrame:
    """Parquet scan, pruned to ``columns`` plus ``always`` when a column list is given.

    Listed columns the file lacks are skipped; the load plan is where they are reported.
    """
    df = spark.read.parquet(path)
    if not columns:
        return df
    wanted = list(dict.fromkeys([*columns, *always]))
    return df.select(*[c for c in wanted if c in df.columns])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    **fields: str,
) -> DataFrame:
    """Data CSV with a header and a declared schema (inference would read the file twice).

    ``fields`` fill placeholders of a path pattern such as ``policies_{veh_type}.csv``.
    """
    return spark.read.csv(path.format(**fields) if fields else path, header=True, schema=schema)


def read_metadata_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Settings CSV, everything as text, with ``#`` comment lines left out.

    A sheet written by hand is one file with a header line. With ``columns`` there is none, so a sheet made
    by a job may have any number of parts.
    """
    if columns is None:
        return spark.read.csv(path, header=True, comment="#", inferSchema=False)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, comment="#")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


#: Rows of a report, which is one file.
REPORT_ROWS = 100_000


def _report(df: DataFrame) -> DataFrame:
    """``df`` in one part; more than ``REPORT_ROWS`` rows raise in the task that writes them."""
    number = "__report_row"  # numbers of one part count from 0
    rows = df.coalesce(1).withColumn(number, F.monotonically_increasing_id())
    refuse = F.raise_error(F.lit(f"a report has at most {REPORT_ROWS} rows; write larger tables as Parquet"))
    return rows.filter(F.when(F.col(number) >= REPORT_ROWS, refuse).otherwise(F.lit(True))).drop(number)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink for catalogs, importance tables and other reports of at most ``REPORT_ROWS`` rows."""
    _report(df).write.mode("overwrite").csv(path, header=True)


def write_metrics(df: DataFrame, path: str) -> None:
    """JSON record sink for one-row metrics tables."""
    _report(df).write.mode("overwrite").json(path)


def predictions(df: DataFrame, key: str, target: str) -> DataFrame:
    """Columns of the predictions sink; the key makes the file joinable again."""
    return df.select(key, F.col("pred"), target)
