"""Reading the landed tables (S10) and writing metrics (S8); versioned tables are in ``snapshots``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def write_json(df: DataFrame, path: str) -> None:
    """Metrics sink as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
