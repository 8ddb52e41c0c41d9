"""The document corpus built stage by stage from the landed tables.

Each stage is the library operator applied to the previous stage's output
(incremental form: empty existing tables).  ``corpus_index`` materialises
the search index once per session, model and input folder, like the
reference's stored ``chunk_embeddings`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.constants import EMBEDDING_MODEL
from parchment.operators import chunking, documents, embedding, extract, ingest, keyword
from parchment.operators.joins import bounded_broadcast, narrow_side
from parchment.session import materialize, session_key
from parchment.sources import fixtures

RAW_DIR = "data/raw"


_STAGES: dict = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A pipeline stage's output table: built once per session and input, then read."""
    key = (session_key(spark), sf_dir, name)
    if key not in _STAGES:
        _STAGES[key] = materialize(build(), f"stage-{name}")
    return _STAGES[key]


def corpus_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed objects classified against the previous hash of their source (W1); see :func:`with_content`."""
    def build():
        reg = fixtures.registry(spark, sf_dir)
        return ingest.classify_fetches(fixtures.landed(spark, sf_dir).drop("content"), reg, RAW_DIR)
    return stage(spark, sf_dir, "events", build)


def with_content(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Classified events with what was landed: read where it lies, so the stage table holds no second copy of it."""
    objects = fixtures.landed(spark, sf_dir).select("event_id", "content")
    repeated = objects.groupBy("event_id").count().where("count > 1 AND event_id IS NOT NULL")
    if repeated.limit(1).count():  # each row of an event has the content of its own hash
        objects = fixtures.landed(spark, sf_dir).select("event_id", "content_hash", "content").dropDuplicates(["event_id", "content_hash"])
        same = (F.col("o.event_id") == F.col("e.event_id")) & F.col("o.content_hash").eqNullSafe(F.col("e.content_hash"))
        return objects.alias("o").join(narrow_side(events).alias("e"), same).select("o.content", "e.*")
    return objects.join(narrow_side(events), "event_id")


def fetch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log classified (W1) - the input of registry state, run summary, due sources."""
    def build():
        reg = fixtures.registry(spark, sf_dir)
        return ingest.classify_fetches(fixtures.fetch_log(spark, sf_dir), reg, RAW_DIR)
    return stage(spark, sf_dir, "fetches", build)


def corpus_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        reg = fixtures.registry(spark, sf_dir)
        pending = extract.pending_extraction(corpus_events(spark, sf_dir), reg, _empty_extracted(spark))
        return extract.extract_events(with_content(spark, sf_dir, pending), raw_text="content")
    return stage(spark, sf_dir, "extracted", build)


def _empty_extracted(spark: SparkSession) -> DataFrame:
    return spark.range(0).withColumnRenamed("id", "event_id")


def corpus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = fixtures.registry(spark, sf_dir)
    return documents.pending_documents(corpus_extracted(spark, sf_dir), reg, corpus_events(spark, sf_dir))


def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "documents", lambda: documents.build_documents(corpus_records(spark, sf_dir)))


def corpus_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        pending = chunking.pending_chunks(corpus_documents(spark, sf_dir), corpus_extracted(spark, sf_dir))
        return chunking.build_chunks(pending)
    return stage(spark, sf_dir, "chunks", build)


_INDEX_CACHE: dict = {}


def corpus_index(spark: SparkSession, sf_dir: str, model: str = EMBEDDING_MODEL) -> DataFrame:
    key = (session_key(spark), sf_dir, model)
    if key not in _INDEX_CACHE:
        idx = embedding.search_index(corpus_chunks(spark, sf_dir), corpus_documents(spark, sf_dir), model)
        # the preview is a piece of the text beside it: cut when it is read, not written
        stored = _numbered(idx.drop("preview"), f"index-{model}")
        _INDEX_CACHE[key] = embedding.with_preview(stored).select(*idx.columns, "chunk_no")
    return _INDEX_CACHE[key]


def _numbered(index: DataFrame, name: str) -> DataFrame:
    """The index written with a number per chunk id, ``chunk_no``, which its postings hold instead of the id."""
    rows = _counted(materialize(index.withColumn("chunk_no", F.monotonically_increasing_id()), name))
    again = (rows.groupBy("chunk_id").agg(F.min("chunk_no").alias("_first"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1").drop("_n"))
    if not again.limit(1).count():
        return rows
    one = rows.join(bounded_broadcast(again), "chunk_id", "left")  # rows of one chunk have one number
    return materialize(one.withColumn("chunk_no", F.coalesce("_first", "chunk_no")).drop("_first").select(rows.columns), name)


def _counted(rows: DataFrame) -> DataFrame:
    """``chunk_no`` without the gaps that ``monotonically_increasing_id`` leaves between tasks."""
    task, place = F.shiftright("chunk_no", 33), F.col("chunk_no").bitwiseAND(F.lit((1 << 33) - 1))
    ends = dict(rows.groupBy(task.alias("task")).agg(F.max(place) + 1).collect())  # one row a task of the writing job
    before, total = [], 0
    for t in range(max(ends, default=-1) + 1):
        before.append(total)
        total += ends.get(t, 0)
    if not before:
        return rows
    starts = F.expr(f"array({', '.join(f'{b}L' for b in before)})")
    return rows.withColumn("chunk_no", F.get(starts, task.cast("int")) + place)


def corpus_postings(spark: SparkSession, sf_dir: str, model: str = EMBEDDING_MODEL) -> DataFrame:
    """The index's posting blocks, written once next to the index."""
    key = (session_key(spark), sf_dir, f"postings-{model}")
    if key not in _STAGES:
        _STAGES[key] = keyword.build_postings(corpus_index(spark, sf_dir, model))
    return _STAGES[key]


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table: every benchmark passage is one query (no filters)."""
    from parchment.sources.tables import read_table
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden questions: each benchmark passage; expectations from its lowest gold document.

    Gold documents are those containing the passage verbatim; the expected
    title and agency are those of the source of the lowest gold ``doc_id``.
    Items without any gold document are inactive.
    """
    def build():
        from parchment.sources.tables import read_table
        gold = fixtures.passage_matches(spark, sf_dir)
        docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"))
        first = (gold.join(docs, "doc_id").groupBy("item_id")
                 .agg(F.min_by("source_id", "doc_id").alias("source_id"),
                      F.count(F.lit(1)).alias("gold_documents")))
        reg = fixtures.registry(spark, sf_dir).select("source_id", "source_name", "agency")
        bench = read_table(spark, sf_dir, "benchmark")
        q = bench.join(first, "item_id", "left").join(reg, "source_id", "left")
        return q.select(
            F.col("item_id").alias("question_id"), F.col("text").alias("question_text"),
            F.col("source_name").alias("expected_title_contains"),
            F.lit(None).cast("string").alias("expected_source_url"),
            F.col("agency").alias("expected_agency"),
            F.concat(F.lit("gold documents: "), F.coalesce(F.col("gold_documents"), F.lit(0)).cast("string")).alias("notes"),
            F.col("source_id").isNotNull().alias("is_active"))
    return stage(spark, sf_dir, "questions", build)
