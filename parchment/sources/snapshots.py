"""Versioned tables of parquet folders.

A table is a folder.  Data lies in folders that are written once and never
changed; version ``n`` is the file ``_versions/<n>``, which lists the data
folders of that version and is put in place by one rename, after its data is
complete.  Readers take the highest number, so they never see half a version,
and a writer that loses the race for a number fails instead of overwriting.

Rows lie in buckets by the hash of the table's keys.  An append adds folders;
an upsert rewrites only the buckets that the incoming rows touch and carries
the others over by name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parchment.operators.governance import merge_latest, stage_rows

_BUCKET = "__bucket"


class VersionConflict(RuntimeError):
    """Another writer has put this version in place first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: StructType
    parts: tuple[tuple[int, str], ...]  # (bucket, folder under the table's)


class VersionedTable:
    """A table under ``root`` with unique ``keys`` (null keys are equal); any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 32):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -------------------------------------------------------------- reading
    def latest(self) -> Version | None:
        """The newest version; None while there is none."""
        numbers = [int(n) for n in self._names("_versions") if n.isdigit()]
        return self.version(max(numbers)) if numbers else None

    def version(self, number: int) -> Version:
        stream = self._fs.open(self._path(f"{self.root}/_versions/{number}"))
        try:
            told = json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, StructType.fromJson(told["schema"]), tuple((b, f) for b, f in told["parts"]))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version (the newest by default)."""
        found = self.latest() if number is None else self.version(number)
        if found is None:
            raise FileNotFoundError(f"no version under {self.root}")
        return self._rows(found, found.parts)

    # -------------------------------------------------------------- writing
    def overwrite(self, rows: DataFrame) -> int:
        """A version that holds ``rows`` alone."""
        before = self.latest()
        return self._commit(before, rows.schema, self._write(rows))

    def append(self, rows: DataFrame) -> int:
        """``rows`` whose keys the table does not hold yet are added; of rows with equal keys one is.

        Stored rows stay as they are, whatever an incoming row with their key says.
        """
        before = self.latest()
        staged = stage_rows(rows)
        if before is None:
            return self._commit(None, rows.schema, self._write(merge_latest(None, staged, self.keys, [])))
        stored = self._rows(before, self._touched(before, staged)).select(*self.keys)
        same = [F.col(f"i.{k}").eqNullSafe(F.col(f"s.{k}")) for k in self.keys]
        new = staged.alias("i").join(stored.alias("s"), same, "left_anti")
        parts = self._write(merge_latest(None, new, self.keys, []).select(*before.schema.names))
        return self._commit(before, before.schema, [*before.parts, *parts])

    def upsert(self, rows: DataFrame, order: list[str]) -> int:
        """Per key the row latest by ``order`` stays, an incoming one before a stored one of the same order."""
        before = self.latest()
        staged = stage_rows(rows)
        if before is None:
            return self._commit(None, rows.schema, self._write(merge_latest(None, staged, self.keys, order)))
        touched = self._touched(before, staged)
        merged = merge_latest(self._rows(before, touched), staged, self.keys, order)
        parts = self._write(merged.select(*before.schema.names))
        return self._commit(before, before.schema, [*[p for p in before.parts if p not in set(touched)], *parts])

    # -------------------------------------------------------------- helpers
    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, before: Version, staged: DataFrame) -> list[tuple[int, str]]:
        hit = {r[0] for r in staged.select(self._bucket()).distinct().collect()}  # at most ``buckets`` numbers
        return [p for p in before.parts if p[0] in hit]

    def _rows(self, version: Version, parts) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[f"{self.root}/{folder}" for _, folder in parts])

    def _write(self, rows: DataFrame) -> list[tuple[int, str]]:
        folder = f"data-{uuid.uuid4().hex}"
        rows.withColumn(_BUCKET, self._bucket()).write.option("compression", "zstd").partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        mark = f"{_BUCKET}="
        return [(int(n[len(mark):]), f"{folder}/{n}") for n in self._names(folder) if n.startswith(mark)]

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _commit(self, before: Version | None, schema: StructType, parts) -> int:
        number = before.number + 1 if before else 1
        final = self._path(f"{self.root}/_versions/{number}")
        draft = self._path(f"{self.root}/_versions/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "parts": parts}).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise VersionConflict(f"version {number} of {self.root} is there already")
        return number
