"""Session construction and lineage cutting.

The session is configured for a cluster first: AQE on (runtime coalescing,
skew-join splitting, broadcast only when the runtime size is under the
threshold), UTC session time, Arrow batches for the pandas UDFs.  Local
defaults only apply where the caller has not set a value.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed run clock: every "now()" of the pipeline is this instant so results
# are reproducible (keys and times are derived, never random).
AS_OF = "2024-02-01 00:00:00"

_CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parchment") -> SparkSession:
    """Return the active session, or build one with cluster-safe defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _CLUSTER_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PARCHMENT_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a scratch folder is used only if the session runs in
    one process (``local[...]`` masters: tests, the bench).  On several
    machines every executor would write to its own disk, so that fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share; "
                               f"it is unset and the master is {master!r}")
        root = tempfile.mkdtemp(prefix="parchment-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def session_key(spark: SparkSession) -> str:
    """A stable identity of the running application (for per-session stage tables)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint root and read it back.

    This cuts lineage (a lost executor recomputes from the written table, not
    from the source) and lets several branches reuse one result without
    recomputing an expensive stage such as the embedding UDF.  Written with
    zstd: texts, vectors and postings take about half the bytes of snappy.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
