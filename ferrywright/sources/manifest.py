"""Stored manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import as_manifest


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return as_manifest(spark.read.parquet(path))
