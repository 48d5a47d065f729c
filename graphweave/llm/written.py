"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from graphweave.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: later plans neither repeat its work nor depend on
    an executor that held it."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
