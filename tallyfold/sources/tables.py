"""Scans of landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale directory; projections and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
