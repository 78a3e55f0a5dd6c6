"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``name`` under ``sf_dir``; columns that a query does not use are pruned by the reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
