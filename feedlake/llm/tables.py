"""Reading of the text tables, and intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.sources.scratch import materialise


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and safe against lost executors."""
    return materialise(df, f"llm-{name}")
