"""Helpers shared by the operators of this subpackage: stage tables, Arrow buffers, hashing."""

from __future__ import annotations

import contextlib
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.session import checkpoint_root

# Sorts after every other doc_id: rows without an id count as the largest.
NO_ID = np.iinfo(np.int64).max

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Rows of an Arrow batch: few enough that long texts fit a Python worker, and
# fewer still where each row is a block of some MB.
TEXT_ROWS, BLOCK_ROWS = 512, 8


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, name: str, rows_per_batch: int = TEXT_ROWS) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    The table cuts the lineage (a lost executor rereads it instead of
    recomputing), fixes row positions that later steps refer to, and lets
    several steps share one result.  Shuffle files go as soon as the write ends.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    with settings(spark, {_CLEANUP: "true", _BATCH: str(rows_per_batch)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stage tables that no later step reads (through Spark's own file system layer)."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; Python steps that follow get Arrow batches of ``TEXT_ROWS`` rows at most."""
    if not 0 < int(spark.conf.get(_BATCH)) <= TEXT_ROWS:
        spark.conf.set(_BATCH, str(TEXT_ROWS))
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def whole(docs: DataFrame, **more: Column) -> DataFrame:
    """``row`` (all columns of ``docs`` in one struct) beside ``more``, so that no name can clash with a column of ``docs``.

    ``more`` is computed from the columns of ``docs``; ``select("row.*")`` gives these back.
    """
    return docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in more.items()])


def row_order(docs: DataFrame) -> Column:
    """A hash of a whole row, to choose among rows that repeat an id (maps cannot be hashed and stay out)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, concatenated, and its n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def ids(column) -> np.ndarray:
    """An Arrow integer column as int64; null is ``NO_ID``."""
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    """The inverse of :func:`ids`."""
    return pa.array(values, pa.int64(), mask=values == NO_ID)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def fingerprints(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit fingerprints of the ``width``-byte strings that start at positions ``at`` of ``raw``."""
    if not len(at):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray(len(raw) + 1, "<u8", buffer=padded, strides=(1,))
    h = np.full(len(at), 0x9E3779B97F4A7C15 ^ width, np.uint64)
    for k in range(0, width, 8):
        part = words[at + k]
        if width - k < 8:
            part &= np.uint64((1 << 8 * (width - k)) - 1)
        h ^= mix(part + np.uint64(k + 1))
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return mix(h)
