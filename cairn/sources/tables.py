"""Named Parquet tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``, by Spark's reader, whatever store the folder is in."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
