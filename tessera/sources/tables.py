"""Tables of a folder of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; Spark prunes its columns and pushes filters into the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
