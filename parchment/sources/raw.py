"""Landed raw objects (S2, S3, S5): read bytes with the binaryFile source, hash, decode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.operators.extract import decode_utf8_lenient


def read_raw_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per landed file: path, size, modification time, SHA-256 of the bytes, lenient UTF-8 text.

    ``binaryFile`` reads each file whole (a file is one object); pruning of
    the ``content`` column keeps listings cheap when only metadata is needed.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return raw.select(
        F.col("path").alias("object_path"), "length", F.col("modificationTime").alias("landed_at"),
        F.sha2(F.col("content"), 256).alias("content_hash"),
        decode_utf8_lenient(F.col("content")).alias("raw_text"))


def work_order(df: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Deterministic processing order of pending rows; ``limit`` 0/None means all."""
    out = df.orderBy(*order)
    return out.limit(limit) if limit else out
