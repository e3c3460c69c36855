"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The whole table ``name`` of ``folder``; a single file or a folder of parts."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
