"""Change detection over a landing folder, one micro-batch at a time.

The last known hash of every source is a versioned table: version ``b + 1``
is the state after micro-batch ``b``.  A batch's rows are classified by the
same skew-safe scan as the batch job (W1), so a source that holds most rows
is spread over tasks, with the version before the batch as starting point.
A batch that is run again after a failure reads the same starting version,
replaces its own rows in the sink and adds its version only if that is not
there yet: every row counts once.

Within a batch rows are taken in time order; a row that lands late is
compared with what was known when it arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.operators.ingest import classify_fetches
from parchment.sources.snapshots import VersionedTable

FETCH_SCHEMA = "event_id long, source_id string, fetched_at timestamp, content_hash string"
STATE_SCHEMA = "source_id string, current_hash string"
COLUMNS = ("event_id", "source_id", "fetched_at", "status", "previous_hash")


def known_hashes(spark: SparkSession, work_dir: str) -> VersionedTable:
    """The versioned table of last known hashes, by source."""
    return VersionedTable(spark, f"{work_dir}/known", ["source_id"])


def classify_batch(spark: SparkSession, rows: DataFrame, batch: int, work_dir: str,
                   initial: DataFrame | None = None) -> None:
    """Classify one micro-batch into ``sink/batch=<batch>`` and add the version of the state after it.

    ``initial`` (source_id, current_hash) is the state before the first batch; empty if not given.
    """
    known = known_hashes(spark, work_dir)
    latest = known.latest()
    if latest is None:
        known.overwrite(spark.createDataFrame([], STATE_SCHEMA) if initial is None
                        else initial.select("source_id", "current_hash"))
    # version 1 is the start, version b + 1 the state before batch b
    before = known.read(batch + 1).withColumns({"source_type": F.lit(None).cast("string"),
                                                "source_url": F.lit(None).cast("string")})
    classify_fetches(rows, before).select(*COLUMNS).write.mode("overwrite").parquet(f"{work_dir}/sink/batch={batch}")
    if known.latest().number < batch + 2:
        order = F.struct("fetched_at", "event_id")
        known.upsert(rows.where(F.col("content_hash").isNotNull()).groupBy("source_id").agg(
            F.max_by("content_hash", order).alias("current_hash")), [])


def take_landed(spark: SparkSession, landing: str, work_dir: str, files_per_trigger: int | None = None,
                initial: DataFrame | None = None) -> None:
    """One run: everything that has landed since the last run, then stop (``availableNow``)."""
    reader = spark.readStream.schema(FETCH_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def handle(arrived: DataFrame, batch: int) -> None:
        # written once: the scan reads it several times, and the job below runs in the adaptive session
        path = f"{work_dir}/arrived/batch={batch}"
        arrived.write.mode("overwrite").parquet(path)
        classify_batch(spark, spark.read.schema(FETCH_SCHEMA).parquet(path), batch, work_dir, initial)

    query = (reader.parquet(landing).writeStream.foreachBatch(handle).trigger(availableNow=True)
             .option("checkpointLocation", f"{work_dir}/checkpoint").start())
    query.awaitTermination()


def detected(spark: SparkSession, work_dir: str) -> DataFrame:
    """The classified rows of all finished batches."""
    done = known_hashes(spark, work_dir).latest()
    schema = FETCH_SCHEMA.replace("content_hash string", "status string, previous_hash string, batch int")
    if done is None or done.number < 2:
        return spark.createDataFrame([], schema).select(*COLUMNS)
    rows = spark.read.schema(schema).option("basePath", f"{work_dir}/sink").parquet(f"{work_dir}/sink")
    return rows.where(F.col("batch") < done.number - 1).select(*COLUMNS)


def run_change_detection(spark: SparkSession, fetches: DataFrame, work_dir: str, runs: int = 4) -> DataFrame:
    """Land a fetch log in ``runs`` slices of time, as a landing folder fills, with one run after each."""
    rows = fetches.select("event_id", "source_id", "fetched_at", "content_hash")
    shares = [i / runs for i in range(1, runs)]
    cuts = rows.agg(F.percentile_approx("fetched_at", shares)).collect()[0][0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        slice_ = rows.where(((F.col("fetched_at") >= low) if low is not None else F.lit(True))
                            & ((F.col("fetched_at") < high) if high is not None else F.lit(True)))
        slice_.write.mode("append").parquet(f"{work_dir}/landing")
        take_landed(spark, f"{work_dir}/landing", work_dir)
    return detected(spark, work_dir)
