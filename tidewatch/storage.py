"""Folders that a finished write has marked, on any file system that Spark writes to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has finished (its success mark is there)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def exists(spark: SparkSession, folder: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_once(df: DataFrame, folder: str, *partition_by: str) -> DataFrame:
    """``df`` written to ``folder`` unless an earlier try has finished that; the rows that are there."""
    spark = df.sparkSession
    if not is_complete(spark, folder):
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
