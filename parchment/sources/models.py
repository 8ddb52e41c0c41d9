"""Kept models with their records (S9): model folders written once, found through a versioned table."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.sources.snapshots import VersionedTable


class ModelStore:
    """Models by name under ``root``.

    A model's folder is complete before the version of the table that names
    it is put in place, so a reader gets a model and the record that belongs
    to it, or the ones before.  Earlier folders stay.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._table = VersionedTable(spark, f"{self.root}/records", ["name"], buckets=1)

    def save(self, name: str, model: PipelineModel, record: dict) -> int:
        """Keep ``model`` under ``name`` in place of the one before; returns the table's version."""
        folder = f"model-{uuid.uuid4().hex}"
        model.write().save(f"{self.root}/{folder}")
        row = self.spark.createDataFrame([(name, folder, json.dumps(record))], "name string, folder string, record string")
        return self._table.upsert(row.withColumn("saved_at", F.current_timestamp()), ["saved_at"])

    def records(self) -> DataFrame:
        """name, folder, record (JSON), saved_at of the models kept."""
        return self._table.read()

    def load(self, name: str) -> tuple[PipelineModel, dict]:
        """The model last kept under ``name`` and its record."""
        found = self.records().where(F.col("name") == name).first()
        if found is None:
            raise KeyError(f"no model {name!r} under {self.root}")
        return PipelineModel.load(f"{self.root}/{found['folder']}"), json.loads(found["record"])
