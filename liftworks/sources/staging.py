"""Staging of intermediates that several jobs read.

A staged frame is a Parquet table in the shared folder the session names in
``spark.checkpoint.dir`` or by ``setCheckpointDir``. Whoever stages a table that is used up before
a result is returned releases it; tables behind a lazy result stay for the session's owner to clear. It cuts lineage, survives the loss of executors, and later passes read
only the columns they need; ``count()`` on it comes from the file footers.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="liftworks-")


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_root(spark.sparkContext.applicationId)


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/liftworks/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "frame", spread: bool = False) -> DataFrame:
    """Write once, read back.

    ``spread`` is for rows that many jobs read: if the files give fewer tasks than there are cores
    (so the table is small), they are written again in as many parts.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    cores = spark.sparkContext.defaultParallelism
    if spread and staged.rdd.getNumPartitions() < cores:
        again = stage(staged.repartition(cores), label)
        release(staged)
        return again
    return staged


def release(staged: DataFrame) -> None:
    """Delete a staged table once nothing reads it any more; other frames are left alone."""
    path = getattr(staged, "_staged_at", None)
    if path:
        spark = staged.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store Spark reads."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)
