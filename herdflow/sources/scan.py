"""Scan helper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan as Spark splits it (``spark.sql.files.maxPartitionBytes``)."""
    return spark.read.parquet(path)
