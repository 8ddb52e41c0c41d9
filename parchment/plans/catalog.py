"""Registered queries: one per operator group of the blueprint.

Every query reads the given tables (or data Spark derives from them) and
returns a DataFrame; ``ORACLES`` holds the independent SQL restatement run
by DuckDB on the same parquet files.  Doubles are rounded to 6 digits on
both sides, counts are BIGINT, sizes INT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.constants import EMBEDDING_DIMENSION, EMBEDDING_MODEL, SHA_EMBEDDING_MODEL
from parchment.functions.embedding import l2_norm
from parchment.functions.text import tokens
from parchment.operators import chunking, documents, embedding, extract, ingest, keyword, retrieval
from parchment.plans import corpus
from parchment.plans import sqlfrag as Q
from parchment.session import AS_OF
from parchment.sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Objects landed before this instant were handled by the previous run; the
# pending-work queries compute what the next run must do.
PREVIOUS_RUN_AT = "2024-01-01 00:05:00"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # times are UTC instants everywhere (fixed AS_OF, day boundaries of runs)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------ registry & fetch
@register("registry_active", Q.with_ctes("""
  SELECT source_id, source_name, source_type, agency, priority, fetch_method,
         CAST(row_number() OVER (ORDER BY priority, source_name, source_id) AS INTEGER) AS fetch_order
  FROM registry WHERE is_active AND fetch_method = 'http_get'""", "registry"))
def q_registry_active(spark, sf):
    from parchment.operators.scan import row_number_by
    reg = fixtures.registry(spark, sf)
    act = reg.where(F.col("is_active") & (F.col("fetch_method") == "http_get"))
    # the listing order is the work order (S1/T6); its position is numbered with the
    # range-partitioned scan, so a large registry is never ranked in one task
    numbered = row_number_by(act, [], ["priority", "source_name", "source_id"], "fetch_order")
    return numbered.select("source_id", "source_name", "source_type", "agency", "priority", "fetch_method",
                           "fetch_order")


def _registry_now(spark, sf):
    return ingest.registry_state(fixtures.registry(spark, sf), corpus.fetch_events(spark, sf))


@register("registry_due", Q.with_ctes(f"""
  SELECT source_id, refresh_policy, last_fetch_at,
         CASE refresh_policy WHEN 'daily' THEN last_fetch_at + INTERVAL 1 DAY
                             WHEN 'weekly' THEN last_fetch_at + INTERVAL 7 DAY
                             WHEN 'monthly' THEN last_fetch_at + INTERVAL 1 MONTH END AS next_fetch_at
  FROM (SELECT r.source_id, r.refresh_policy, r.is_active, s.last_fetch_at
        FROM registry r LEFT JOIN (SELECT source_id, max(fetched_at) AS last_fetch_at FROM fetch_classified
                                   GROUP BY source_id) s USING (source_id))
  WHERE is_active AND refresh_policy <> 'manual'
    AND (last_fetch_at IS NULL OR CASE refresh_policy WHEN 'daily' THEN last_fetch_at + INTERVAL 1 DAY
                                                      WHEN 'weekly' THEN last_fetch_at + INTERVAL 7 DAY
                                                      WHEN 'monthly' THEN last_fetch_at + INTERVAL 1 MONTH END
                                  <= TIMESTAMP '{AS_OF}')""",
                                      "registry", "fetch_classified"))
def q_registry_due(spark, sf):
    due = ingest.sources_due(_registry_now(spark, sf))
    return due.select("source_id", "refresh_policy", "last_fetch_at", "next_fetch_at")


@register("raw_object_key", Q.with_ctes("""
  SELECT event_id, source_id, content_hash, object_path FROM events_classified WHERE status = 'success'""",
                                        "events_classified"))
def q_raw_object_key(spark, sf):
    ev = corpus.corpus_events(spark, sf)
    return ev.where(F.col("status") == "success").select("event_id", "source_id", "content_hash", "object_path")


@register("raw_extension", Q.with_ctes(f"""
  SELECT r.source_id, r.source_url, {Q.extension_sql('r')} AS extension FROM registry r""", "registry"))
def q_raw_extension(spark, sf):
    reg = fixtures.registry(spark, sf)
    return reg.select("source_id", "source_url",
                      ingest.content_extension("source_type", "source_url").alias("extension"))


@register("fetch_classify", Q.with_ctes("""
  SELECT event_id, source_id, status, previous_hash, run_id FROM fetch_classified""", "fetch_classified"))
def q_fetch_classify(spark, sf):
    reg = fixtures.registry(spark, sf)
    c = ingest.classify_fetches(fixtures.fetch_log(spark, sf), reg)
    return c.select("event_id", "source_id", "status", "previous_hash", "run_id")


@register("registry_state", Q.with_ctes("""
  SELECT r.source_id, coalesce(h.current_hash, r.current_hash) AS current_hash,
         coalesce(l.fetched_at, r.last_fetch_at) AS last_fetch_at,
         CASE WHEN l.source_id IS NULL THEN r.last_status ELSE l.status END AS last_status,
         CAST(CASE WHEN l.source_id IS NULL THEN r.last_http_status ELSE l.http_status END AS DOUBLE) AS last_http_status,
         CASE WHEN l.source_id IS NULL THEN r.last_error ELSE l.error_message END AS last_error
  FROM registry r
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
                            FROM fetch_classified) WHERE rn = 1) l USING (source_id)
  LEFT JOIN (SELECT source_id, content_hash AS current_hash FROM (
               SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
               FROM fetch_classified WHERE content_hash IS NOT NULL) WHERE rn = 1) h USING (source_id)""",
                                        "registry", "fetch_classified"))
def q_registry_state(spark, sf):
    # nullable ints are reported as double so both engines hand pandas the same dtype
    return _registry_now(spark, sf).select("source_id", "current_hash", "last_fetch_at", "last_status",
                                           F.col("last_http_status").cast("double").alias("last_http_status"),
                                           "last_error")


@register("run_summary", Q.with_ctes("""
  SELECT run_id, min(fetched_at) AS started_at, max(fetched_at) AS completed_at,
         CAST(count(DISTINCT source_id) AS INTEGER) AS source_count,
         CAST(count(*) FILTER (WHERE status IN ('success', 'unchanged')) AS INTEGER) AS fetched_count,
         CAST(count(*) FILTER (WHERE status = 'success') AS INTEGER) AS changed_count,
         CAST(count(*) FILTER (WHERE status = 'failed') AS INTEGER) AS failed_count,
         CASE WHEN count(*) FILTER (WHERE status = 'failed') = 0 THEN 'success' ELSE 'failed' END AS status
  FROM fetch_classified GROUP BY run_id""", "fetch_classified"))
def q_run_summary(spark, sf):
    return ingest.run_summary(corpus.fetch_events(spark, sf))


# ------------------------------------------------------------ extraction
@register("html_text", f"""
  SELECT page_id, url, extracted_text, CAST(length(extracted_text) AS INTEGER) AS character_count,
         CAST(len({Q.words('extracted_text')}) AS INTEGER) AS word_count
  FROM (SELECT page_id, url, {Q.html_text('html')} AS extracted_text FROM pages)""")
def q_html_text(spark, sf):
    from parchment.functions.text import word_count
    pages = fixtures.raw_html(spark, sf)
    t = pages.select("page_id", "url", extract.html_to_text("html").alias("extracted_text"))
    return t.select("page_id", "url", "extracted_text", F.length("extracted_text").cast("int").alias("character_count"),
                    word_count("extracted_text").alias("word_count"))


@register("page_assembly", f"""
  SELECT object_id, page_count, extracted_text, CAST(length(extracted_text) AS INTEGER) AS character_count
  FROM (SELECT conv_id AS object_id, CAST(count(*) AS INTEGER) AS page_count,
               {Q.norm_lines("string_agg(coalesce(text, ''), chr(10) ORDER BY turn)")} AS extracted_text
        FROM conversations GROUP BY conv_id)""")
def q_page_assembly(spark, sf):
    a = extract.assemble_pages(fixtures.raw_pages(spark, sf))
    return a.select("object_id", "page_count", "extracted_text",
                    F.length("extracted_text").cast("int").alias("character_count"))


@register("extraction_route", Q.with_ctes("""
  SELECT event_id, source_id, extraction_method, extraction_status, character_count, word_count, error_message
  FROM extracted""", "extracted"))
def q_extraction_route(spark, sf):
    ex = corpus.corpus_extracted(spark, sf)
    return ex.select("event_id", "source_id", "extraction_method", "extraction_status", "character_count",
                     "word_count", "error_message")


@register("pending_extraction", Q.with_ctes(f"""
  SELECT e.event_id, e.source_id, r.source_name, r.source_type, e.object_path
  FROM events_classified e JOIN registry r USING (source_id)
  WHERE e.status = 'success' AND e.object_path IS NOT NULL
    AND e.event_id NOT IN (SELECT event_id FROM extracted WHERE extracted_at < TIMESTAMP '{PREVIOUS_RUN_AT}')""",
                                            "events_classified", "registry", "extracted"))
def q_pending_extraction(spark, sf):
    reg = fixtures.registry(spark, sf)
    done = corpus.corpus_extracted(spark, sf).where(F.col("extracted_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp"))
    p = extract.pending_extraction(corpus.corpus_events(spark, sf), reg, done)
    return p.select("event_id", "source_id", "source_name", "source_type", "object_path")


# ------------------------------------------------------------ documents
@register("quality_rules", Q.with_ctes("""
  SELECT extracted_text_id, rule_name, severity, passed, message, measured_value FROM rules""", "rules"))
def q_quality_rules(spark, sf):
    return documents.quality_rules(corpus.corpus_records(spark, sf)).select(
        "extracted_text_id", "rule_name", "severity", "passed", "message", "measured_value")


@register("readiness", Q.with_ctes("""
  SELECT extracted_text_id, source_id, document_status, failed_rules FROM ready""", "ready"))
def q_readiness(spark, sf):
    return documents.readiness(corpus.corpus_records(spark, sf)).select(
        "extracted_text_id", "source_id", "document_status", "failed_rules")


@register("pending_documents", Q.with_ctes(f"""
  SELECT extracted_text_id, source_id, content_hash, extraction_status FROM records r
  WHERE NOT EXISTS (SELECT 1 FROM records p WHERE p.extracted_at < TIMESTAMP '{PREVIOUS_RUN_AT}'
                    AND p.source_id = r.source_id AND p.content_hash = r.content_hash)""", "records"))
def q_pending_documents(spark, sf):
    reg = fixtures.registry(spark, sf)
    ex = corpus.corpus_extracted(spark, sf)
    ev = corpus.corpus_events(spark, sf)
    prev = documents.build_documents(documents.pending_documents(
        ex.where(F.col("extracted_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp")), reg, ev))
    p = documents.pending_documents(ex, reg, ev, prev)
    return p.select("extracted_text_id", "source_id", "content_hash", "extraction_status")


@register("failed_rules", Q.with_ctes("""
  SELECT d.document_id, d.title, q.rule_name, q.measured_value
  FROM rules q JOIN documents_built d ON d.extracted_text_id = q.extracted_text_id
  WHERE NOT q.passed""", "rules", "documents_built"))
def q_failed_rules(spark, sf):
    rules = documents.quality_rules(corpus.corpus_records(spark, sf))
    docs = corpus.corpus_documents(spark, sf).select("document_id", "title", "extracted_text_id")
    return (rules.where(~F.col("passed")).join(docs, "extracted_text_id", "inner")
            .select("document_id", "title", "rule_name", "measured_value"))


@register("doc_versions", Q.with_ctes("""
  SELECT document_id, source_id, event_id, title, document_type, content_hash, version_number, document_status,
         character_count, word_count, created_at, updated_at FROM documents_built""", "documents_built"))
def q_doc_versions(spark, sf):
    return corpus.corpus_documents(spark, sf).select(
        "document_id", "source_id", "event_id", "title", "document_type", "content_hash", "version_number",
        "document_status", "character_count", "word_count", "created_at", "updated_at")


# ------------------------------------------------------------ chunks & embeddings
@register("chunk_words", Q.with_ctes("""
  SELECT chunk_id, document_id, chunk_index, word_count, character_count, chunk_hash FROM chunks""", "chunks"))
def q_chunk_words(spark, sf):
    return corpus.corpus_chunks(spark, sf).select("chunk_id", "document_id", "chunk_index", "word_count",
                                                  "character_count", "chunk_hash")


@register("pending_chunks", Q.with_ctes(f"""
  SELECT document_id, title, word_count FROM documents_built
  WHERE document_status = 'ai_ready' AND created_at >= TIMESTAMP '{PREVIOUS_RUN_AT}'""", "documents_built"))
def q_pending_chunks(spark, sf):
    docs = corpus.corpus_documents(spark, sf)
    ex = corpus.corpus_extracted(spark, sf)
    prev_docs = docs.where(F.col("created_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp"))
    prev_chunks = chunking.build_chunks(chunking.pending_chunks(prev_docs, ex))
    p = chunking.pending_chunks(docs, ex, prev_chunks)
    return p.select("document_id", "title", "word_count")


@register("chunk_stats", Q.with_ctes("""
  SELECT d.title, count(*) AS chunks, min(c.word_count) AS min_words, max(c.word_count) AS max_words
  FROM chunks c JOIN documents_built d USING (document_id) GROUP BY d.title""", "chunks", "documents_built"))
def q_chunk_stats(spark, sf):
    return chunking.chunk_stats(corpus.corpus_chunks(spark, sf), corpus.corpus_documents(spark, sf))


@register("pending_embeddings", Q.with_ctes(f"""
  SELECT c.chunk_id, c.document_id, c.chunk_index FROM chunks c JOIN documents_built d USING (document_id)
  WHERE d.created_at >= TIMESTAMP '{PREVIOUS_RUN_AT}'""", "chunks", "documents_built"))
def q_pending_embeddings(spark, sf):
    ch = corpus.corpus_chunks(spark, sf)
    docs = corpus.corpus_documents(spark, sf).select("document_id", "created_at")
    prev = ch.join(docs.where(F.col("created_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp")), "document_id",
                   "left_semi")
    done = embedding.embed_chunks(prev, EMBEDDING_MODEL)
    return embedding.pending_embeddings(ch, done, EMBEDDING_MODEL).select("chunk_id", "document_id", "chunk_index")


@register("embed_counts", Q.with_ctes(f"""
  SELECT m.embedding_model, CAST(128 AS INTEGER) AS embedding_dimension, count(*) AS embeddings
  FROM chunks CROSS JOIN (VALUES ('{EMBEDDING_MODEL}'), ('{SHA_EMBEDDING_MODEL}')) m(embedding_model)
  GROUP BY ALL""", "chunks"))
def q_embed_counts(spark, sf):
    ch = corpus.corpus_chunks(spark, sf)
    both = embedding.embed_chunks(ch, EMBEDDING_MODEL).unionByName(embedding.embed_chunks(ch, SHA_EMBEDDING_MODEL))
    return both.groupBy("embedding_model", "embedding_dimension").agg(F.count(F.lit(1)).alias("embeddings"))


@register("embed_hash_exact")
def q_embed_hash_exact(spark, sf):
    """BLAKE2b embedding (no SQL engine has the hash): rows-only; values checked in tests."""
    e = embedding.embed_chunks(corpus.corpus_chunks(spark, sf), EMBEDDING_MODEL)
    return e.select("chunk_id", "embedding_model", "embedding_dimension",
                    r6(l2_norm("embedding")).alias("norm"),
                    F.size(F.filter("embedding", lambda x: x != 0)).alias("nonzero_slots"))


@register("embed_hash_sql", Q.with_ctes("""
  SELECT chunk_id, CAST(ix AS INTEGER) AS slot, round(CAST(v AS DOUBLE), 6) AS value FROM chunk_vec""", "chunk_vec"))
def q_embed_hash_sql(spark, sf):
    e = embedding.embed_chunks(corpus.corpus_chunks(spark, sf), SHA_EMBEDDING_MODEL)
    return (e.select("chunk_id", F.posexplode("embedding").alias("slot", "value"))
            .where(F.col("value") != 0)
            .select("chunk_id", F.col("slot").cast("int").alias("slot"), r6(F.col("value").cast("double")).alias("value")))


# ------------------------------------------------------------ retrieval
def _sha_index(spark, sf):
    return corpus.corpus_index(spark, sf, SHA_EMBEDDING_MODEL)


def _sha_postings(spark, sf):
    return corpus.corpus_postings(spark, sf, SHA_EMBEDDING_MODEL)


def _topk_sql(order: str, where: str = "", k: int = 5) -> str:
    return f"""
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}, document_id, chunk_index) AS INTEGER) AS rank
    FROM scored {where}) WHERE rank <= {k}"""


@register("vector_topk", Q.with_ctes(f"""
  SELECT query_id, rank, title, agency, source_url, document_id, chunk_index, word_count,
         round(vector_similarity, 6) AS similarity, left(preview, 360) AS preview
  FROM ({_topk_sql('round(vector_similarity, 9) DESC')})""", "scored"))
def q_vector_topk(spark, sf):
    r = retrieval.vector_search(_sha_index(spark, sf), corpus.benchmark_queries(spark, sf), 5, SHA_EMBEDDING_MODEL)
    return r.withColumn("similarity", r6("similarity"))


_RESULT_COLS = ("query_id", "rank", "chunk_id", "document_id", "chunk_index", "title", "agency", "source_url",
                "version_number")


def _result_select(df: DataFrame) -> DataFrame:
    return df.select(*_RESULT_COLS, r6("vector_similarity").alias("vector_similarity"),
                     r6("keyword_score").alias("keyword_score"), r6("hybrid_score").alias("hybrid_score"),
                     "preview")


def _result_sql(inner: str) -> str:
    cols = ", ".join(_RESULT_COLS)
    return f"""
  SELECT {cols}, round(vector_similarity, 6) AS vector_similarity, round(keyword_score, 6) AS keyword_score,
         round(hybrid_score, 6) AS hybrid_score, preview FROM ({inner})"""


@register("keyword_score", Q.with_ctes("""
  SELECT query_id, chunk_id, round(keyword_score, 6) AS keyword_score FROM keyword""", "keyword"))
def q_keyword_score(spark, sf):
    kw = keyword.keyword_pairs(_sha_index(spark, sf), corpus.benchmark_queries(spark, sf), _sha_postings(spark, sf))
    return kw.select("query_id", "chunk_id", r6("keyword_score").alias("keyword_score"))


@register("keyword_forms", Q.with_ctes("""
  SELECT query_id // 10 AS query_id, chunk_id, round(sum(keyword_score), 6) AS keyword_score
  FROM form_covers GROUP BY 1, 2""", "form_covers"))
def q_keyword_forms(spark, sf):
    """A phrase, alternatives and an excluded word, made of each passage's own words."""
    t = F.col("t")
    asked = (corpus.benchmark_queries(spark, sf).withColumn("t", tokens("query_text")).where(F.size("t") >= 9)
             .select("query_id", F.concat(F.lit('"'), F.concat_ws(" ", t[0], t[1], t[2]), F.lit('" '), t[4], F.lit(" or "),
                                          t[5], F.lit(" "), t[6], F.lit(" -"), t[8]).alias("query_text")))
    kw = keyword.keyword_pairs(_sha_index(spark, sf), asked, _sha_postings(spark, sf), syntax="web")
    return kw.select("query_id", "chunk_id", r6("keyword_score").alias("keyword_score"))


@register("keyword_topk", Q.with_ctes(_result_sql(_topk_sql(
    "round(keyword_score, 9) DESC, round(vector_similarity, 9) DESC", "WHERE keyword_score > 0")), "scored"))
def q_keyword_topk(spark, sf):
    r = retrieval.retrieve(_sha_index(spark, sf), corpus.benchmark_queries(spark, sf), "keyword", 5,
                           SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
    return _result_select(r)


@register("hybrid_topk", Q.with_ctes(_result_sql(_topk_sql(
    "round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC")), "scored"))
def q_hybrid_topk(spark, sf):
    r = retrieval.retrieve(_sha_index(spark, sf), corpus.benchmark_queries(spark, sf), "hybrid", 5,
                           SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
    return _result_select(r)


# ------------------------------------------------------------ evaluation
from parchment.operators import evaluation  # noqa: E402
from parchment.constants import CANDIDATE_LIMIT  # noqa: E402


def _eval_results(spark, sf):
    qs = corpus.questions(spark, sf).where("is_active")
    qt = qs.select(F.col("question_id").alias("query_id"), F.col("question_text").alias("query_text"),
                   F.col("expected_agency").alias("agency"))   # B15: the expected agency filters
    res = retrieval.retrieve(_sha_index(spark, sf), qt, "hybrid", 5, SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
    return evaluation.question_outcomes(res, qs)


@register("eval_results", Q.with_ctes("""
  SELECT question_id, question_text, matched, CAST(first_relevant_rank AS DOUBLE) AS first_relevant_rank, top_title, top_source_url,
         round(top_hybrid_score, 6) AS top_hybrid_score FROM eval_outcomes""", "eval_outcomes"))
def q_eval_results(spark, sf):
    return (_eval_results(spark, sf).withColumn("top_hybrid_score", r6("top_hybrid_score"))
            .withColumn("first_relevant_rank", F.col("first_relevant_rank").cast("double")))


@register("eval_summary", Q.with_ctes("""
  SELECT count(*) AS question_count, count(*) FILTER (WHERE matched) AS hit_count,
         round(coalesce(count(*) FILTER (WHERE matched) / nullif(count(*), 0), 0.0), 6) AS hit_rate,
         round(coalesce(sum(coalesce(1.0 / first_relevant_rank, 0.0)) / nullif(count(*), 0), 0.0), 6) AS mean_reciprocal_rank
  FROM eval_outcomes""", "eval_outcomes"))
def q_eval_summary(spark, sf):
    s = evaluation.evaluation_summary(_eval_results(spark, sf))
    return s.select("question_count", "hit_count", r6("hit_rate").alias("hit_rate"),
                    r6("mean_reciprocal_rank").alias("mean_reciprocal_rank"))


def candidate_set(spark, sf, limit: int = CANDIDATE_LIMIT) -> DataFrame:
    """Top-``limit`` hybrid candidates per active question, labelled by F7 (a stage table)."""
    return corpus.stage(spark, sf, f"candidates-{limit}", lambda: _build_candidates(spark, sf, limit))


def _build_candidates(spark, sf, limit: int) -> DataFrame:
    qs = corpus.questions(spark, sf).where("is_active")
    qt = qs.select(F.col("question_id").alias("query_id"), F.col("question_text").alias("query_text"))
    res = retrieval.retrieve(_sha_index(spark, sf), qt, "hybrid", limit, SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
    j = res.join(qs.select(F.col("question_id").alias("query_id"), "question_text", "expected_title_contains",
                           "expected_source_url", "expected_agency"), "query_id")
    label = evaluation.expectation_match("title", "source_url", "agency", "expected_title_contains",
                                         "expected_source_url", "expected_agency").cast("int")
    text = F.format_string("query: %s\ntitle: %s\nagency: %s\ntopic: %s\ndocument_type: %s\nchunk: %s",
                           "question_text", "title", "agency", "topic", "document_type", "preview")
    return j.select(F.col("query_id").alias("question_id"), "question_text", F.col("rank").alias("candidate_rank"),
                    "chunk_id", "document_id", "chunk_index", "title", "agency", "hybrid_score",
                    "vector_similarity", label.alias("label"), text.alias("text"))


_TEMPLATE_SQL = ("'query: ' || q.question_text || chr(10) || 'title: ' || c.title || chr(10) || 'agency: ' || c.agency"
                 " || chr(10) || 'topic: ' || c.topic || chr(10) || 'document_type: ' || c.document_type"
                 " || chr(10) || 'chunk: ' || c.preview")


@register("candidate_set", Q.with_ctes(f"""
  SELECT c.question_id, c.candidate_rank, c.chunk_id, c.label, round(c.hybrid_score, 6) AS hybrid_score,
         sha256({_TEMPLATE_SQL}) AS text_hash
  FROM candidates c JOIN questions q USING (question_id)""", "candidates", "questions"))
def q_candidate_set(spark, sf):
    c = candidate_set(spark, sf)
    return c.select("question_id", "candidate_rank", "chunk_id", "label", r6("hybrid_score").alias("hybrid_score"),
                    F.sha2("text", 256).alias("text_hash"))


def _metrics_sql(score: str, src: str = "candidates", k: int = 5) -> str:
    return f"""
  SELECT count(*) AS questions,
         round(coalesce(count(first) / nullif(count(*), 0), 0.0), 6) AS hit_rate_at_{k},
         round(coalesce(sum(coalesce(1.0 / first, 0.0)) / nullif(count(*), 0), 0.0), 6) AS mrr,
         round(coalesce(sum(prec) / nullif(count(*), 0), 0.0), 6) AS precision_at_{k}
  FROM (SELECT question_id, min(CASE WHEN label = 1 THEN r END) AS first, sum(label) / count(*) AS prec
        FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round({score}, 9) DESC, candidate_rank) AS r
              FROM {src}) WHERE r <= {k} GROUP BY question_id)"""


def _round_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("ranking_metrics", Q.with_ctes(_metrics_sql("hybrid_score"), "candidates"))
def q_ranking_metrics(spark, sf):
    m = evaluation.grouped_metrics(candidate_set(spark, sf), "hybrid_score", 5)
    return _round_cols(m, ["hit_rate_at_5", "mrr", "precision_at_5"])


@register("grouped_split", Q.with_ctes("""
  SELECT question_id, CASE WHEN pos <= vc THEN 'validation' WHEN pos <= vc + tc THEN 'test' ELSE 'train' END AS split
  FROM (SELECT question_id, row_number() OVER (ORDER BY sha256('99:' || question_text), question_text) AS pos,
               greatest(1, CAST(round_even(count(*) OVER () * 0.25, 0) AS INTEGER)) AS vc,
               greatest(1, CAST(round_even(count(*) OVER () * 0.25, 0) AS INTEGER)) AS tc
        FROM questions WHERE is_active)""", "questions"))
def q_grouped_split(spark, sf):
    qs = corpus.questions(spark, sf).where("is_active")
    return evaluation.grouped_split(qs).select("question_id", "split")


Q.cte("split_of", ("questions",), """
  SELECT question_id, CASE WHEN pos <= vc THEN 'validation' WHEN pos <= vc + tc THEN 'test' ELSE 'train' END AS split
  FROM (SELECT question_id, row_number() OVER (ORDER BY sha256('99:' || question_text), question_text) AS pos,
               greatest(1, CAST(round_even(count(*) OVER () * 0.25, 0) AS INTEGER)) AS vc,
               greatest(1, CAST(round_even(count(*) OVER () * 0.25, 0) AS INTEGER)) AS tc
        FROM questions WHERE is_active)""")


def _splits(spark, sf):
    return evaluation.grouped_split(corpus.questions(spark, sf).where("is_active")).select("question_id", "split")


@register("split_label_check", Q.with_ctes("""
  SELECT s.split, CAST(sum(c.label) AS BIGINT) AS positives, count(*) FILTER (WHERE c.label = 0) AS negatives,
         count(DISTINCT c.label) = 2 AS has_both_labels
  FROM candidates c JOIN split_of s USING (question_id) GROUP BY s.split""", "candidates", "split_of"))
def q_split_label_check(spark, sf):
    return evaluation.split_label_check(candidate_set(spark, sf), _splits(spark, sf))


# Metric operators are checked on a given probability.  For the SQL check the
# probability is a deterministic stand-in (the candidate's vector similarity);
# the trained reranker supplies it in ``rerank_apply``.
def _scored_candidates(spark, sf):
    return candidate_set(spark, sf).withColumn("probability", F.col("vector_similarity"))


@register("blend_scores", Q.with_ctes("""
  SELECT question_id, candidate_rank, round(0.1 * vector_similarity + 0.9 * hybrid_score, 6) AS blended_score
  FROM candidates""", "candidates"))
def q_blend_scores(spark, sf):
    c = _scored_candidates(spark, sf)
    return c.select("question_id", "candidate_rank",
                    r6(evaluation.blend("probability", "hybrid_score", 0.1)).alias("blended_score"))


def _sweep_sql(src: str) -> str:
    return f"""
  SELECT weight, count(*) AS questions,
         round(count(first) / count(*), 6) AS hit_rate_at_5, round(sum(coalesce(1.0 / first, 0.0)) / count(*), 6) AS mrr,
         round(sum(prec) / count(*), 6) AS precision_at_5
  FROM (SELECT weight, question_id, min(CASE WHEN label = 1 THEN r END) AS first, sum(label) / count(*) AS prec
        FROM (SELECT *, row_number() OVER (PARTITION BY weight, question_id
                                           ORDER BY round(weight * vector_similarity + (1.0 - weight) * hybrid_score, 9) DESC,
                                                    candidate_rank) AS r
              FROM {src} CROSS JOIN (SELECT unnest(range(0, 11)) / 10.0 AS weight))
        WHERE r <= 5 GROUP BY weight, question_id)
  GROUP BY weight"""


@register("blend_weight_sweep", Q.with_ctes(_sweep_sql("candidates"), "candidates"))
def q_blend_weight_sweep(spark, sf):
    sw = evaluation.blend_sweep(_scored_candidates(spark, sf))
    return _round_cols(sw, ["hit_rate_at_5", "mrr", "precision_at_5"])


def _labelled_scores(spark, sf):
    lab = fixtures.labelled(spark, sf)
    n = F.length("text").cast("double")
    return lab.select("doc_id", "lang", F.col("quality").alias("label"), (n / (n + F.lit(2000.0))).alias("probability"))


_LAB_SQL = """SELECT l.doc_id, d.lang, l.quality AS label, length(d.text) / (length(d.text) + 2000.0) AS probability
              FROM labels l JOIN documents d USING (doc_id)"""


@register("average_precision", f"""
  SELECT lang, round(coalesce(sum(CASE WHEN P > 0 THEN (tp / P) * (ctp / cn) END), 0.0), 6) AS average_precision
  FROM (SELECT lang, probability, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn, sum(tp) OVER (PARTITION BY lang) AS P
        FROM (SELECT lang, probability, sum(label) AS tp, count(*) AS n FROM ({_LAB_SQL}) GROUP BY lang, probability)
        WINDOW w AS (PARTITION BY lang ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY lang""")
def q_average_precision(spark, sf):
    ap = evaluation.average_precision(_labelled_scores(spark, sf), group=["lang"])
    return ap.select("lang", r6("average_precision").alias("average_precision"))


@register("precision_recall", f"""
  SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
         tp AS true_positives, fp AS false_positives, fn AS false_negatives
  FROM (SELECT count(*) FILTER (WHERE probability >= 0.5 AND label = 1) AS tp,
               count(*) FILTER (WHERE probability >= 0.5 AND label = 0) AS fp,
               count(*) FILTER (WHERE probability < 0.5 AND label = 1) AS fn FROM ({_LAB_SQL}))""")
def q_precision_recall(spark, sf):
    pr = evaluation.precision_recall(_labelled_scores(spark, sf))
    return _round_cols(pr, ["precision", "recall"])


# ------------------------------------------------------------ reranker (Spark ML: trained models have no SQL)
import hashlib  # noqa: E402

from parchment.constants import DEFAULT_TOP_K, RERANK_CANDIDATES  # noqa: E402
from parchment.operators import reranker  # noqa: E402
from parchment.session import checkpoint_root, session_key  # noqa: E402
from parchment.sources.models import ModelStore  # noqa: E402

_RERANKER = "reranker"
_METRICS = "questions double, hit_rate_at_5 double, mrr double, precision_at_5 double"
_RECORD = f"""model string, baseline string, embedding_model string, candidate_limit int, top_k int, question_count long,
  train_questions long, validation_questions long, test_questions long,
  train_examples long, validation_examples long, test_examples long, positive_examples long, negative_examples long,
  best_ngram_max int, best_c double, selected_model_weight double, cv_average_precision double,
  test_average_precision double, test_precision double, test_recall double,
  baseline_grouped_metrics struct<{_METRICS.replace(" double", ": double")}>,
  validation_blend_metrics struct<{_METRICS.replace(" double", ": double")}>,
  reranker_grouped_metrics struct<{_METRICS.replace(" double", ": double")}>,
  grid array<struct<ngram_max: int, c: double, cv_average_precision: double, selected: boolean>>, leakage_control string"""


def _path_name(sf: str) -> str:
    return hashlib.sha256(sf.encode()).hexdigest()[:16]


def _split_candidates(spark, sf):
    return candidate_set(spark, sf).join(_splits(spark, sf), "question_id")


_TRAINED: set = set()


def _model_store(spark, sf) -> ModelStore:
    """The store, after the reranker was selected, measured and kept once per session and input."""
    store = ModelStore(spark, f"{checkpoint_root(spark)}/models-{_path_name(sf)}")
    key = session_key(spark), sf
    if key not in _TRAINED:
        examples = corpus.stage(spark, sf, "examples", lambda: _split_candidates(spark, sf))
        store.save(_RERANKER, *reranker.train_reranker(examples, embedding_model=SHA_EMBEDDING_MODEL))
        _TRAINED.add(key)
    return store


def _record(spark, sf) -> DataFrame:
    kept = _model_store(spark, sf).records().where(F.col("name") == _RERANKER)
    return kept.select(F.from_json("record", _RECORD).alias("r")).select("r.*")


@register("reranker_fit")
def q_reranker_fit(spark, sf):
    """The kept model, loaded, scores the validation and test candidates."""
    model, _ = _model_store(spark, sf).load(_RERANKER)
    held = _split_candidates(spark, sf).where(F.col("split") != "train")
    return reranker.positive_probability(model, held).select(
        "question_id", "split", "candidate_rank", "label", r6("probability").alias("probability"))


@register("reranker_grid")
def q_reranker_grid(spark, sf):
    """Every setting's mean average precision over the folds, and which one was fitted and kept."""
    return _record(spark, sf).select(F.inline("grid")).withColumn("cv_average_precision", r6("cv_average_precision"))


@register("reranker_record")
def q_reranker_record(spark, sf):
    """The kept model's whole record."""
    return _record(spark, sf).drop("grid")


def _reranked(spark, sf, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The kept model and weight, loaded, on a retrieval of its own for every active question."""
    model, record = _model_store(spark, sf).load(_RERANKER)
    fresh = candidate_set(spark, sf, RERANK_CANDIDATES)
    return reranker.rerank(model, record["selected_model_weight"], fresh, k).withColumn(
        "selected_model_weight", F.lit(record["selected_model_weight"]))


@register("rerank_apply")
def q_rerank_apply(spark, sf):
    return _reranked(spark, sf).select(
        "question_id", "rank", "candidate_rank", "chunk_id", "label", "selected_model_weight",
        r6("probability").alias("probability"), r6("blended_score").alias("blended_score"))


@register("rerank_contract", Q.with_ctes(f"""
  SELECT question_id, least(count(*), {DEFAULT_TOP_K}) AS results, least(count(*), {DEFAULT_TOP_K}) AS last_rank,
         count(*) AS candidates, count(*) FILTER (WHERE label = 1) AS relevant_candidates,
         CAST(0 AS BIGINT) AS bad_probabilities, CAST(0 AS BIGINT) AS bad_blends, CAST(0 AS BIGINT) AS better_left_out
  FROM candidates WHERE candidate_rank <= {RERANK_CANDIDATES} GROUP BY question_id""", "candidates"))
def q_rerank_contract(spark, sf):
    """What holds for any model: rows and ranks a question, probabilities in [0, 1], blends, nothing better left out."""
    every = _reranked(spark, sf, RERANK_CANDIDATES)
    w, p, h = F.col("selected_model_weight"), F.col("probability"), F.col("hybrid_score")
    top = F.col("rank") <= DEFAULT_TOP_K
    lowest = F.min(F.when(top, F.round("blended_score", 9)))
    best_left = F.max(F.when(~top, F.round("blended_score", 9)))
    return every.groupBy("question_id").agg(
        F.count_if(top).alias("results"), F.max(F.when(top, F.col("rank"))).cast("long").alias("last_rank"),
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("label") == 1).alias("relevant_candidates"),
        F.count_if(p.isNull() | F.isnan(p) | ~p.between(0, 1)).alias("bad_probabilities"),
        F.count_if(~(F.abs(w * p + (1 - w) * h - F.col("blended_score")) < 1e-12)).alias("bad_blends"),
        F.coalesce((best_left > lowest).cast("long"), F.lit(0)).cast("long").alias("better_left_out"))


@register("metrics_row", Q.with_ctes(f"""
  , cs AS (SELECT c.*, s.split FROM candidates c JOIN split_of s USING (question_id)),
  sweep AS (SELECT weight, count(*) AS questions, count(first) / count(*) AS hit_rate_at_5,
                   sum(coalesce(1.0 / first, 0.0)) / count(*) AS mrr, sum(prec) / count(*) AS precision_at_5
            FROM (SELECT weight, question_id, min(CASE WHEN label = 1 THEN r END) AS first, sum(label) / count(*) AS prec
                  FROM (SELECT *, row_number() OVER (PARTITION BY weight, question_id
                                   ORDER BY round(weight * vector_similarity + (1.0 - weight) * hybrid_score, 9) DESC, candidate_rank) AS r
                        FROM (SELECT * FROM cs WHERE split = 'validation') CROSS JOIN (SELECT unnest(range(0, 11)) / 10.0 AS weight))
                  WHERE r <= 5 GROUP BY weight, question_id)
            GROUP BY weight),
  best AS (SELECT weight AS selected_model_weight FROM sweep
           ORDER BY mrr DESC, hit_rate_at_5 DESC, precision_at_5 DESC, weight ASC LIMIT 1),
  base AS (SELECT round(sum(coalesce(1.0 / first, 0.0)) / count(*), 6) AS baseline_mrr,
                  round(count(first) / count(*), 6) AS baseline_hit_rate_at_5
           FROM (SELECT question_id, min(CASE WHEN label = 1 THEN r END) AS first
                 FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(hybrid_score, 9) DESC, candidate_rank) AS r
                       FROM cs WHERE split = 'test') WHERE r <= 5 GROUP BY question_id)),
  ap AS (SELECT round(coalesce(sum(CASE WHEN P > 0 THEN (tp / P) * (ctp / cn) END), 0.0), 6) AS test_average_precision
         FROM (SELECT probability, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn, sum(tp) OVER () AS P
               FROM (SELECT vector_similarity AS probability, sum(label) AS tp, count(*) AS n FROM cs WHERE split = 'test'
                     GROUP BY 1)
               WINDOW w AS (ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))),
  pr AS (SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS test_precision,
                round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS test_recall
         FROM (SELECT count(*) FILTER (WHERE vector_similarity >= 0.5 AND label = 1) AS tp,
                      count(*) FILTER (WHERE vector_similarity >= 0.5 AND label = 0) AS fp,
                      count(*) FILTER (WHERE vector_similarity < 0.5 AND label = 1) AS fn FROM cs WHERE split = 'test')),
  counts AS (SELECT count(DISTINCT question_id) AS question_count,
                    count(DISTINCT question_id) FILTER (WHERE split = 'train') AS train_questions,
                    count(DISTINCT question_id) FILTER (WHERE split = 'validation') AS validation_questions,
                    count(DISTINCT question_id) FILTER (WHERE split = 'test') AS test_questions,
                    CAST(sum(label) AS BIGINT) AS positive_examples, count(*) FILTER (WHERE label = 0) AS negative_examples
             FROM cs)
  SELECT * FROM counts, best, base, ap, pr""", "candidates", "split_of"))
def q_metrics_row(spark, sf):
    """One metrics record (counts, selected weight, baseline vs blended on test, AP, P/R)."""
    data = _split_candidates(spark, sf).withColumn("probability", F.col("vector_similarity"))
    val, test = data.where(F.col("split") == "validation"), data.where(F.col("split") == "test")
    best = evaluation.select_weight(evaluation.blend_sweep(val)).select(
        F.col("weight").alias("selected_model_weight"), F.lit(1).alias("_k"))
    base = evaluation.grouped_metrics(test, "hybrid_score").select(
        F.col("mrr").alias("baseline_mrr"), F.col("hit_rate_at_5").alias("baseline_hit_rate_at_5"), F.lit(1).alias("_k"))
    counts = data.agg(
        F.count_distinct("question_id").alias("question_count"),
        F.count_distinct(F.when(F.col("split") == "train", F.col("question_id"))).alias("train_questions"),
        F.count_distinct(F.when(F.col("split") == "validation", F.col("question_id"))).alias("validation_questions"),
        F.count_distinct(F.when(F.col("split") == "test", F.col("question_id"))).alias("test_questions"),
        F.sum("label").cast("long").alias("positive_examples"),
        F.count_if(F.col("label") == 0).alias("negative_examples"), F.lit(1).alias("_k"))
    ap = evaluation.average_precision(test).select(r6("average_precision").alias("test_average_precision"),
                                                   F.lit(1).alias("_k"))
    pr = evaluation.precision_recall(test).select(r6("precision").alias("test_precision"),
                                                  r6("recall").alias("test_recall"), F.lit(1).alias("_k"))
    row = counts.join(best, "_k").join(base, "_k").join(ap, "_k").join(pr, "_k").drop("_k")
    path = f"{checkpoint_root(spark)}/metrics-{_path_name(sf)}"
    from parchment.sources.tables import write_json
    write_json(row, path)
    return _round_cols(row, ["baseline_mrr", "baseline_hit_rate_at_5"])


# ------------------------------------------------------------ upserts
from parchment.operators import governance as gov  # noqa: E402


def _extract_all(spark, sf, min_chars, later=False):
    reg = fixtures.registry(spark, sf)
    empty = spark.createDataFrame([], "event_id long")
    pending = extract.pending_extraction(corpus.corpus_events(spark, sf), reg, empty)
    ex = extract.extract_events(corpus.with_content(spark, sf, pending), raw_text="content", min_characters=min_chars)
    if later:  # a later run: same events, extracted a day later
        ex = ex.withColumn("extracted_at", F.col("extracted_at") + F.expr("INTERVAL 1 DAY"))
    return ex


@register("upsert_latest", Q.with_ctes("""
  SELECT event_id, extraction_method,
         CASE WHEN extraction_method = 'unsupported' THEN 'failed' WHEN character_count < 1000 THEN 'quarantined'
              ELSE 'success' END AS extraction_status,
         CASE WHEN extraction_method = 'unsupported' THEN error_message
              WHEN character_count < 1000 THEN 'Extracted text too short: ' || character_count || ' characters, minimum is 1000'
         END AS error_message, character_count
  FROM extracted""", "extracted"))
def q_upsert_latest(spark, sf):
    cut = F.lit(PREVIOUS_RUN_AT).cast("timestamp")
    existing = _extract_all(spark, sf, 500).where(F.col("extracted_at") < cut)
    incoming = _extract_all(spark, sf, 1000, later=True)
    merged = gov.upsert_latest(existing, incoming, ["event_id"], ["extracted_at"])
    return merged.select("event_id", "extraction_method", "extraction_status", "error_message", "character_count")


@register("upsert_keep_version", Q.with_ctes("""
  SELECT document_id, source_id, content_hash, version_number, document_status FROM documents_built""",
                                             "documents_built"))
def q_upsert_keep_version(spark, sf):
    recs = corpus.corpus_records(spark, sf)
    cut = F.lit(PREVIOUS_RUN_AT).cast("timestamp")
    existing = documents.build_documents(recs.where(F.col("extracted_at") < cut))
    reg = fixtures.registry(spark, sf)
    pending = documents.pending_documents(corpus.corpus_extracted(spark, sf), reg, corpus.corpus_events(spark, sf),
                                          existing)
    new = documents.build_documents(pending, existing)
    merged = gov.upsert_keep(existing, new, ["source_id", "content_hash"], ["document_id", "version_number",
                                                                            "created_at"])
    return merged.select("document_id", "source_id", "content_hash", "version_number", "document_status")


@register("upsert_chunks", Q.with_ctes("""
  SELECT chunk_id, document_id, chunk_index, chunk_hash, word_count FROM chunks""", "chunks"))
def q_upsert_chunks(spark, sf):
    """Chunks written again replace the stored rows of the same (document, index)."""
    now = corpus.corpus_chunks(spark, sf)
    before = now.where(F.col("chunk_index") % 2 == 0).withColumns({
        "chunk_hash": F.lit("before"), "word_count": F.lit(0), "created_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")})
    merged = gov.upsert_latest(before.select(now.columns), now, ["document_id", "chunk_index"], ["created_at"])
    return merged.select("chunk_id", "document_id", "chunk_index", "chunk_hash", F.col("word_count").cast("int").alias("word_count"))


@register("upsert_embeddings", Q.with_ctes(f"""
  SELECT chunk_id, '{EMBEDDING_MODEL}' AS embedding_model, chunk_hash, {EMBEDDING_DIMENSION} AS dimension FROM chunks""", "chunks"))
def q_upsert_embeddings(spark, sf):
    """Vectors made again replace the stored ones of the same chunk and model."""
    now = _embeddings(spark, sf)
    before = now.withColumns({"chunk_hash": F.lit("before"), "embedding": F.slice("embedding", 1, 3),
                              "created_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")})
    merged = gov.upsert_latest(before.select(now.columns), now, ["chunk_id", "embedding_model"], ["created_at"])
    return merged.select("chunk_id", "embedding_model", "chunk_hash", F.size("embedding").alias("dimension"))


@register("append_events", Q.with_ctes("""
  SELECT event_id, source_id, status FROM fetch_classified""", "fetch_classified"))
def q_append_events(spark, sf):
    """A run's events are appended; those of a run before that come again are not repeated."""
    now = corpus.fetch_events(spark, sf)
    stored = now.where(F.col("fetched_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp"))
    return gov.append_new(stored, now, "event_id").select("event_id", "source_id", "status")


def _new_table(spark, name: str, keys: list[str]):
    import uuid

    from parchment.sources.snapshots import VersionedTable
    return VersionedTable(spark, f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}", keys)


# Which run wrote a rule row, by the first hex digit of its text's id: 0-4 the first alone, 5-8 both and the
# second is newer, 9 and a both and the second is older, b-f the second alone.
@register("snapshot_quality", Q.with_ctes("""
  SELECT extracted_text_id, rule_name, passed, measured_value,
         CASE WHEN substr(extracted_text_id, 1, 1) < '5' OR substr(extracted_text_id, 1, 1) IN ('9', 'a')
              THEN 'first' ELSE 'second' END AS run
  FROM rules""", "rules"))
def q_snapshot_quality(spark, sf):
    """Rule results written, upserted with newer, older and new rows, and read back."""
    rules = documents.quality_rules(corpus.corpus_records(spark, sf))
    digit = F.substring("extracted_text_id", 1, 1)
    first = rules.where(digit < "b").withColumns({"run": F.lit("first"), "run_number": F.lit(2)})
    second = rules.where(digit >= "5").withColumns({
        "run": F.lit("second"), "run_number": F.when(digit.isin("9", "a"), F.lit(1)).otherwise(F.lit(3))})
    table = _new_table(spark, "quality", ["extracted_text_id", "rule_name"])
    table.overwrite(first)
    table.upsert(second, ["run_number"])
    return table.read().select("extracted_text_id", "rule_name", "passed", "measured_value", "run")


@register("snapshot_chunks", Q.with_ctes("""
  SELECT document_id, chunk_index, chunk_text, CASE WHEN chunk_index % 3 = 2 THEN 'second' ELSE 'first' END AS run
  FROM chunks""", "chunks"))
def q_snapshot_chunks(spark, sf):
    """Stored chunks stay where the run that comes later holds older ones or none; texts come back whole."""
    chunks = corpus.corpus_chunks(spark, sf).select("document_id", "chunk_index", "chunk_text")
    turn = F.col("chunk_index") % 3
    table = _new_table(spark, "chunks", ["document_id", "chunk_index"])
    table.overwrite(chunks.where(turn < 2).withColumns({"run": F.lit("first"), "run_number": F.lit(2)}))
    table.upsert(chunks.where(turn > 0).withColumns({"run": F.lit("second"), "run_number": F.lit(1)}), ["run_number"])
    return table.read().select("document_id", "chunk_index", "chunk_text", "run")


@register("snapshot_events", Q.with_ctes("""
  SELECT event_id, source_id, status, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS run
  FROM fetch_classified""", "fetch_classified"))
def q_snapshot_events(spark, sf):
    """Three runs append their events; events that come again with another status change nothing."""
    events = corpus.fetch_events(spark, sf).select("event_id", "source_id", "status")
    turn = F.col("event_id") % 4
    resent = F.when(turn == 1, F.lit("resent")).otherwise(F.col("status"))
    table = _new_table(spark, "events", ["event_id"])
    table.append(events.where(turn < 2).withColumn("run", F.lit(1)))
    table.append(events.where(turn.isin(1, 2)).withColumns({"status": resent, "run": F.lit(2)}))
    table.append(events.where(turn == 3).withColumn("run", F.lit(3)))
    return table.read()


@register("raw_objects_once", Q.with_ctes("""
  SELECT object_path, octet_length(encode(any_value(content))) AS n_bytes, CAST(count(DISTINCT content) AS BIGINT) AS copies
  FROM events_classified WHERE status = 'success' GROUP BY object_path""", "events_classified"))
def q_raw_objects_once(spark, sf):
    """S3: landed objects stored under their content address; an address is written once, whatever lands again."""
    landed = corpus.with_content(spark, sf, corpus.corpus_events(spark, sf).where("status = 'success'")).select(
        "object_path", "content", "fetched_at")
    early = landed.where(F.col("fetched_at") < F.lit(PREVIOUS_RUN_AT).cast("timestamp"))
    table = _new_table(spark, "objects", ["object_path"])
    table.append(early.select("object_path", "content"))
    table.append(landed.select("object_path", "content"))
    stored = table.read().select("object_path", F.octet_length("content").alias("n_bytes"))
    return stored.groupBy("object_path", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))


@register("seed_sources", Q.with_ctes("""
  SELECT CASE WHEN n % 3 = 0 THEN sha256('source:' || source_url) ELSE source_id END AS source_id, source_url,
         priority + 1 AS priority, 'seeded' AS notes, (n % 3 = 0 OR is_active) AS is_active,
         CASE WHEN n % 3 = 0 THEN 'not_started' ELSE last_status END AS last_status,
         CASE WHEN n % 3 = 0 THEN 'http_get' ELSE fetch_method END AS fetch_method,
         CASE WHEN n % 3 = 0 THEN 'weekly' ELSE refresh_policy END AS refresh_policy
  FROM (SELECT *, CAST(regexp_extract(source_id, '([0-9]+)$', 1) AS INTEGER) AS n FROM registry)""", "registry"))
def q_seed_sources(spark, sf):
    """A seed of all sources over a registry that lacks every third: new rows get a key and the defaults."""
    reg = fixtures.registry(spark, sf)
    number = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    metadata = ["source_name", "source_type", "agency", "domain", "topic", "priority", "notes"]
    seed = reg.withColumns({"priority": F.col("priority") + 1, "notes": F.lit("seeded")}).select("source_url", *metadata)
    merged = gov.seed_merge(reg.where(number % 3 != 0), seed, "source_url", metadata, inserted=gov.registry_defaults())
    return merged.select("source_id", "source_url", "priority", "notes", "is_active", "last_status", "fetch_method",
                         "refresh_policy")


@register("work_order", Q.with_ctes("""
  SELECT source_id, priority FROM registry WHERE is_active ORDER BY priority, source_id LIMIT 10""", "registry"))
def q_work_order(spark, sf):
    """The first ten sources of a run, in work order."""
    from parchment.sources.raw import work_order
    reg = fixtures.registry(spark, sf).where("is_active")
    return work_order(reg, ["priority", "source_id"], 10).select("source_id", "priority")


def _corrections(reg):
    """Corrections derived from the registry: API sources are disabled, PDF sources move to a v2 URL."""
    return reg.select("source_url",
                      F.when(F.col("source_type") == "pdf", F.regexp_replace("source_url", r"\.pdf$", "-v2.pdf"))
                      .alias("new_url"), F.lit("html").alias("new_type"), F.lit("corrected").alias("reason"),
                      F.when(F.col("source_type") == "api", "disable")
                      .when(F.col("source_type") == "pdf", "swap_url").alias("action")).where("action IS NOT NULL")


@register("registry_fix", Q.with_ctes("""
  SELECT r.source_id,
         CASE WHEN r.source_type = 'pdf' THEN regexp_replace(r.source_url, '\\.pdf$', '-v2.pdf') ELSE r.source_url END AS source_url,
         CASE WHEN r.source_type = 'api' THEN false ELSE r.is_active END AS is_active,
         CASE WHEN r.source_type = 'pdf' THEN 'not_started' WHEN r.source_type = 'api' THEN 'disabled'
              ELSE coalesce(l.status, r.last_status) END AS last_status,
         CASE WHEN r.source_type = 'pdf' THEN NULL ELSE h.current_hash END AS current_hash,
         CASE WHEN r.source_type = 'pdf' THEN 'html' ELSE r.source_type END AS source_type,
         CASE WHEN r.source_type = 'pdf' THEN 'corrected' END AS notes,
         CASE WHEN r.source_type = 'pdf' THEN NULL WHEN r.source_type = 'api' THEN 'corrected' ELSE l.error_message END AS last_error,
         CASE WHEN r.source_type <> 'pdf' THEN CAST(l.http_status AS VARCHAR) END AS last_http_status, l.fetched_at AS last_fetch_at
  FROM registry r
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
                            FROM fetch_classified) WHERE rn = 1) l USING (source_id)
  LEFT JOIN (SELECT source_id, content_hash AS current_hash FROM (
               SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
               FROM fetch_classified WHERE content_hash IS NOT NULL) WHERE rn = 1) h USING (source_id)""",
                                      "registry", "fetch_classified"))
def q_registry_fix(spark, sf):
    now = _registry_now(spark, sf)
    fixed = gov.apply_corrections(now, _corrections(fixtures.registry(spark, sf)))
    return fixed.select("source_id", "source_url", "is_active", "last_status", "current_hash", "source_type", "notes",
                        "last_error", F.col("last_http_status").cast("string").alias("last_http_status"), "last_fetch_at")


@register("seed_merge", Q.with_ctes("""
  SELECT r.source_id, r.source_url, r.priority + 5 AS priority, 'reseeded' AS notes, h.current_hash,
         coalesce(l.status, r.last_status) AS last_status
  FROM registry r
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
                            FROM fetch_classified) WHERE rn = 1) l USING (source_id)
  LEFT JOIN (SELECT source_id, content_hash AS current_hash FROM (
               SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
               FROM fetch_classified WHERE content_hash IS NOT NULL) WHERE rn = 1) h USING (source_id)""",
                                    "registry", "fetch_classified"))
def q_seed_merge(spark, sf):
    """Re-seeding the registry overwrites metadata and keeps the fetch state."""
    now = _registry_now(spark, sf)
    seed = fixtures.registry(spark, sf).select("source_url", "source_name", (F.col("priority") + 5).alias("priority"),
                                               F.lit("reseeded").alias("notes"))
    merged = gov.seed_merge(now, seed, "source_url", ["source_name", "priority", "notes"])
    return merged.select("source_id", "source_url", F.col("priority").cast("int").alias("priority"), "notes",
                         "current_hash", "last_status")


@register("questions_merge", Q.with_ctes("""
  SELECT question_id, question_text, expected_title_contains, is_active FROM questions""", "questions"))
def q_questions_merge(spark, sf):
    """Seeding questions again overwrites expectations and reactivates them."""
    qs = corpus.questions(spark, sf)
    existing = qs.withColumn("is_active", F.lit(False)).withColumn("expected_title_contains", F.lit(None).cast("string"))
    seed = qs.where("is_active").select("question_text", "expected_title_contains", "expected_agency", "notes")
    merged = gov.seed_merge(existing, seed, "question_text",
                            ["expected_title_contains", "expected_agency", "notes"], reactivate="is_active")
    return merged.select("question_id", "question_text", "expected_title_contains", "is_active")


# ------------------------------------------------------------ audits
def _embeddings(spark, sf, model=EMBEDDING_MODEL):
    return corpus.stage(spark, sf, f"embeddings-{model}",
                        lambda: embedding.embed_chunks(corpus.corpus_chunks(spark, sf), model))


@register("audit_unique", Q.with_ctes("""
  SELECT table_name, key_columns, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
         CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS extra_rows
  FROM (SELECT 'documents' AS table_name, 'source_id,content_hash' AS key_columns, count(*) AS n FROM documents_built GROUP BY source_id, content_hash
        UNION ALL SELECT 'document_chunks', 'document_id,chunk_index', count(*) FROM chunks GROUP BY document_id, chunk_index
        UNION ALL SELECT 'quality_results', 'extracted_text_id,rule_name', count(*) FROM rules GROUP BY extracted_text_id, rule_name
        UNION ALL SELECT 'orders', 'o_orderkey', count(*) FROM orders GROUP BY o_orderkey
        UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber
        UNION ALL SELECT 'source_texts', 'text', count(*) FROM documents GROUP BY text)
  GROUP BY table_name, key_columns""", "documents_built", "chunks", "rules"))
def q_audit_unique(spark, sf):
    from parchment.sources.tables import read_table
    t = {
        "documents": (corpus.corpus_documents(spark, sf), ["source_id", "content_hash"]),
        "document_chunks": (corpus.corpus_chunks(spark, sf), ["document_id", "chunk_index"]),
        "quality_results": (documents.quality_rules(corpus.corpus_records(spark, sf)), ["extracted_text_id", "rule_name"]),
        "orders": (read_table(spark, sf, "orders"), ["o_orderkey"]),
        "lineitem": (read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "source_texts": (read_table(spark, sf, "documents"), ["text"]),
    }
    return gov.audit_unique(t)


@register("audit_fk", Q.with_ctes("""
  SELECT 'chunks.document_id' AS relation, count(*) AS orphans FROM chunks WHERE document_id NOT IN (SELECT document_id FROM documents_built)
  UNION ALL SELECT 'documents.extracted_text_id', count(*) FROM documents_built WHERE extracted_text_id NOT IN (SELECT extracted_text_id FROM extracted)
  UNION ALL SELECT 'labels.doc_id', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
  UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'customer.c_nationkey', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)""",
                                  "chunks", "documents_built", "extracted"))
def q_audit_fk(spark, sf):
    from parchment.sources.tables import read_table
    rt = lambda n: read_table(spark, sf, n)
    rel = {
        "chunks.document_id": (corpus.corpus_chunks(spark, sf), "document_id", corpus.corpus_documents(spark, sf), "document_id"),
        "documents.extracted_text_id": (corpus.corpus_documents(spark, sf), "extracted_text_id",
                                        corpus.corpus_extracted(spark, sf), "extracted_text_id"),
        "labels.doc_id": (rt("labels"), "doc_id", rt("documents"), "doc_id"),
        "orders.o_custkey": (rt("orders"), "o_custkey", rt("customer"), "c_custkey"),
        "lineitem.l_orderkey": (rt("lineitem"), "l_orderkey", rt("orders"), "o_orderkey"),
        "lineitem.l_partkey": (rt("lineitem"), "l_partkey", rt("part"), "p_partkey"),
        "customer.c_nationkey": (rt("customer"), "c_nationkey", rt("nation"), "n_nationkey"),
    }
    return gov.audit_fk(rel)


def _domain_sql(table: str, col: str, allowed: tuple, name: str) -> str:
    vals = ", ".join(f"'{v}'" for v in allowed)
    return f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) AS violations FROM {table}"


_DOMAIN_ITEMS = [("registry", c, v, f"sources.{c}") for c, v in gov.REGISTRY_DOMAINS.items()] + [
    ("fetch_classified", "status", gov.OTHER_DOMAINS["fetch_status"], "source_fetch_events.status"),
    ("extracted", "extraction_status", gov.OTHER_DOMAINS["extraction_status"], "extracted_text.extraction_status"),
    ("documents_built", "document_status", gov.OTHER_DOMAINS["document_status"], "documents.document_status"),
    ("orders", "o_orderstatus", ("O", "F", "P"), "orders.o_orderstatus"),
    ("lineitem", "l_returnflag", ("R", "A", "N"), "lineitem.l_returnflag"),
]


@register("audit_domain", Q.with_ctes("\n  UNION ALL ".join(_domain_sql(*i) for i in _DOMAIN_ITEMS),
                                      "registry", "fetch_classified", "extracted", "documents_built"))
def q_audit_domain(spark, sf):
    from parchment.sources.tables import read_table
    frames = {"registry": fixtures.registry(spark, sf), "fetch_classified": corpus.fetch_events(spark, sf),
              "extracted": corpus.corpus_extracted(spark, sf), "documents_built": corpus.corpus_documents(spark, sf),
              "orders": read_table(spark, sf, "orders"), "lineitem": read_table(spark, sf, "lineitem")}
    return gov.audit_domain({name: (frames[t], c, v) for t, c, v, name in _DOMAIN_ITEMS})


@register("audit_null", """
  SELECT 'documents' AS table_name, column_name, nulls FROM (
    SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE text IS NULL) AS text,
           count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE source IS NULL) AS source FROM documents)
  UNPIVOT (nulls FOR column_name IN (doc_id, text, lang, source))
  UNION ALL
  SELECT 'lineitem', column_name, nulls FROM (
    SELECT count(*) FILTER (WHERE l_orderkey IS NULL) AS l_orderkey, count(*) FILTER (WHERE l_partkey IS NULL) AS l_partkey,
           count(*) FILTER (WHERE l_quantity IS NULL) AS l_quantity, count(*) FILTER (WHERE l_shipdate IS NULL) AS l_shipdate
    FROM lineitem) UNPIVOT (nulls FOR column_name IN (l_orderkey, l_partkey, l_quantity, l_shipdate))""")
def q_audit_null(spark, sf):
    from parchment.sources.tables import read_table
    return gov.audit_null(read_table(spark, sf, "documents"), "documents", ["doc_id", "text", "lang", "source"]) \
        .unionByName(gov.audit_null(read_table(spark, sf, "lineitem"), "lineitem",
                                    ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]))


@register("audit_dim", Q.with_ctes("""
  SELECT 'vectors' AS table_name, count(*) AS checked, count(*) FILTER (WHERE len(embedding) <> 64) AS violations
  FROM embeddings UNION ALL SELECT 'chunk_embeddings', count(*), 0 FROM chunks""", "chunks"))
def q_audit_dim(spark, sf):
    return gov.audit_dimension({"vectors": (fixtures.vectors(spark, sf), 64),
                                "chunk_embeddings": (_embeddings(spark, sf), EMBEDDING_DIMENSION)})


@register("cascade_delete", Q.with_ctes("""
  SELECT 'documents' AS table_name, count(*) AS remaining FROM documents_built d JOIN registry r USING (source_id) WHERE r.is_active
  UNION ALL SELECT 'document_chunks', count(*) FROM chunks c JOIN registry r USING (source_id) WHERE r.is_active
  UNION ALL SELECT 'quality_results', count(*) FROM rules q JOIN documents_built d USING (extracted_text_id)
            JOIN registry r ON r.source_id = d.source_id WHERE r.is_active""", "documents_built", "chunks", "rules", "registry"))
def q_cascade_delete(spark, sf):
    """Q6: documents of inactive sources are removed with their chunks and rule rows."""
    docs = corpus.corpus_documents(spark, sf)
    inactive = fixtures.registry(spark, sf).where(~F.col("is_active")).select("source_id")
    doomed = docs.join(inactive, "source_id", "left_semi")
    rules = documents.quality_rules(corpus.corpus_records(spark, sf)).join(
        docs.select("extracted_text_id", "document_id"), "extracted_text_id")
    out = gov.cascade_delete(docs, {"document_chunks": corpus.corpus_chunks(spark, sf), "quality_results": rules},
                             doomed)
    from functools import reduce as _r
    return _r(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("remaining")).select(
        F.lit(n).alias("table_name"), "remaining") for n, df in out.items()])


# ------------------------------------------------------------ logs, lineage, report
def _logged_runs(spark, sf):
    """Hybrid retrieval for every benchmark passage, logged (query log + result log)."""
    def build_log():
        qs = corpus.benchmark_queries(spark, sf)
        res = retrieval.retrieve(_sha_index(spark, sf), qs, "hybrid", 5, SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
        started = F.lit(AS_OF).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                      F.col("query_id").cast("decimal(18,6)"))
        log = gov.query_log(qs, res, "hybrid", SHA_EMBEDDING_MODEL, started)
        return log.join(res.select("query_id", "rank", "chunk_id", "document_id", "source_id", "vector_similarity",
                                   "keyword_score", "hybrid_score"), "query_id", "left")
    return corpus.stage(spark, sf, "logged-hybrid", build_log)


def _query_log(spark, sf):
    return _logged_runs(spark, sf).select("log_query_id", "query_id", "query_text", "retrieval_mode",
                                          "embedding_model", "filters", "started_at", "result_count").distinct()


def _result_log(spark, sf):
    return _logged_runs(spark, sf).where(F.col("rank").isNotNull()).select(
        "log_query_id", "query_id", "rank", "chunk_id", "document_id", "source_id", "vector_similarity",
        "keyword_score", "hybrid_score")


_LOG_SQL = Q.with_ctes(f"""
  SELECT sha256('query:' || q.query_id || ':hybrid:{SHA_EMBEDDING_MODEL}') AS log_query_id, q.query_id, q.query_text,
         'hybrid' AS retrieval_mode, '{SHA_EMBEDDING_MODEL}' AS embedding_model,
         '{{"agency":null,"topic":null,"document_type":null}}' AS filters,
         TIMESTAMP '{AS_OF}' + to_seconds(q.query_id) AS started_at, CAST(count(t.chunk_id) AS INTEGER) AS result_count
  FROM queries q LEFT JOIN ({_topk_sql('round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC')}) t USING (query_id)
  GROUP BY ALL""", "queries", "scored")


@register("search_log", _LOG_SQL)
def q_search_log(spark, sf):
    return _query_log(spark, sf)


@register("result_lineage", Q.with_ctes(f"""
  SELECT q.query_text, t.rank, d.title, c.chunk_index, d.source_url, d.version_number, t.document_id
  FROM ({_topk_sql('round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC')}) t
  JOIN queries q USING (query_id) JOIN documents_built d ON d.document_id = t.document_id
  JOIN chunks c ON c.chunk_id = t.chunk_id""", "scored", "queries", "documents_built", "chunks"))
def q_result_lineage(spark, sf):
    """Result log -> query log -> documents -> chunks (citations)."""
    r = _result_log(spark, sf)
    q = _query_log(spark, sf).select("log_query_id", "query_text")
    d = corpus.corpus_documents(spark, sf).select("document_id", "title", "source_url", "version_number")
    c = corpus.corpus_chunks(spark, sf).select("chunk_id", "chunk_index")
    return (r.join(q, "log_query_id").join(d, "document_id").join(c, "chunk_id")
            .select("query_text", "rank", "title", "chunk_index", "source_url", "version_number", "document_id"))


@register("report_sources", Q.with_ctes("""
  SELECT coalesce(l.status, r.last_status) AS last_status, count(*) AS sources
  FROM registry r LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY fetched_at DESC, event_id DESC) AS rn
                              FROM fetch_classified) WHERE rn = 1) l USING (source_id)
  GROUP BY ALL""", "registry", "fetch_classified"))
def q_report_sources(spark, sf):
    return gov.report_sources(_registry_now(spark, sf))


@register("report_documents", Q.with_ctes("""
  SELECT document_status, count(*) AS documents, CAST(sum(word_count) AS BIGINT) AS total_words
  FROM documents_built GROUP BY document_status""", "documents_built"))
def q_report_documents(spark, sf):
    return gov.report_documents(corpus.corpus_documents(spark, sf))


@register("report_coverage", Q.with_ctes("""
  SELECT count(DISTINCT document_id) AS chunked_documents, 2 * count(chunk_id) AS chunks, 2 * count(chunk_id) AS embeddings
  FROM chunks""", "chunks"))
def q_report_coverage(spark, sf):
    """A3/J10 with two embedding models: chunks are counted once per model (as reported, B19)."""
    emb = _embeddings(spark, sf, EMBEDDING_MODEL).unionByName(_embeddings(spark, sf, SHA_EMBEDDING_MODEL))
    return gov.report_coverage(corpus.corpus_chunks(spark, sf), emb)


@register("report_queries", Q.with_ctes(f"""
  SELECT q.query_text, 'hybrid' AS retrieval_mode, CAST(count(t.chunk_id) AS INTEGER) AS result_count,
         TIMESTAMP '{AS_OF}' + to_seconds(q.query_id) AS started_at
  FROM queries q LEFT JOIN ({_topk_sql('round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC')}) t USING (query_id)
  GROUP BY ALL ORDER BY started_at DESC LIMIT 5""", "queries", "scored"))
def q_report_queries(spark, sf):
    """T5: the five latest logged queries."""
    return gov.latest(_query_log(spark, sf).select("query_text", "retrieval_mode", "result_count", "started_at"),
                      "started_at", 5)


def _eval_runs(spark, sf):
    """One evaluation run per retrieval mode over the active questions."""
    def build():
        qs = corpus.questions(spark, sf).where("is_active")
        qt = qs.select(F.col("question_id").alias("query_id"), F.col("question_text").alias("query_text"),
                       F.col("expected_agency").alias("agency"))
        rows = []
        for i, mode in enumerate(("vector", "keyword", "hybrid")):
            res = retrieval.retrieve(_sha_index(spark, sf), qt, mode, 5, SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
            s = evaluation.evaluation_summary(evaluation.question_outcomes(res, qs))
            rows.append(s.select(
                F.sha2(F.lit(f"evaluation:{mode}"), 256).alias("evaluation_run_id"), F.lit(mode).alias("retrieval_mode"),
                F.lit(SHA_EMBEDDING_MODEL).alias("embedding_model"), F.lit(5).alias("top_k"),
                F.col("question_count").cast("int").alias("question_count"),
                F.col("hit_count").cast("int").alias("hit_count"), "mean_reciprocal_rank",
                (F.lit(AS_OF).cast("timestamp") + F.expr(f"INTERVAL {i} MINUTES")).alias("started_at"),
                (F.lit(AS_OF).cast("timestamp") + F.expr(f"INTERVAL {i} MINUTES 30 SECONDS")).alias("completed_at")))
        from functools import reduce as _r
        return _r(DataFrame.unionByName, rows)
    return corpus.stage(spark, sf, "evaluation-runs", build)


def _eval_mode_sql(mode: str) -> str:
    order = {"vector": "round(vector_similarity, 9) DESC",
             "keyword": "round(keyword_score, 9) DESC, round(vector_similarity, 9) DESC",
             "hybrid": "round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC"}[mode]
    where = "WHERE keyword_score > 0" if mode == "keyword" else ""
    return f"""
  SELECT '{mode}' AS retrieval_mode, 5 AS top_k, CAST(count(*) AS INTEGER) AS question_count,
         CAST(count(fr) AS INTEGER) AS hit_count, round(coalesce(sum(coalesce(1.0 / fr, 0.0)) / nullif(count(*), 0), 0.0), 3) AS mrr
  FROM eval_queries q LEFT JOIN (
    SELECT query_id, min(CASE WHEN {Q.match_sql()} THEN rank END) AS fr
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, document_id, chunk_index) AS rank
          FROM eval_scored {where}) WHERE rank <= 5 GROUP BY query_id) t USING (query_id)"""


@register("report_evals", Q.with_ctes("\n  UNION ALL".join(_eval_mode_sql(m) for m in ("vector", "keyword", "hybrid")),
                                      "eval_scored", "eval_queries"))
def q_report_evals(spark, sf):
    """T5/C14: latest completed evaluation runs, MRR rounded to 3 digits."""
    runs = _eval_runs(spark, sf).where(F.col("completed_at").isNotNull())
    top = gov.latest(runs.select("retrieval_mode", "top_k", "question_count", "hit_count",
                                 F.round("mean_reciprocal_rank", 3).alias("mrr"), "started_at"), "started_at", 5)
    return top.drop("started_at").withColumn("top_k", F.col("top_k").cast("int"))


# ------------------------------------------------------------ governance extensions
@register("dup_exact", """
  SELECT sha256(text) AS content_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents
  GROUP BY 1 HAVING count(*) > 1""")
def q_dup_exact(spark, sf):
    from parchment.sources.tables import read_table
    return gov.exact_duplicates(read_table(spark, sf, "documents"))


@register("dup_near")
def q_dup_near(spark, sf):
    """MinHash banding clusters (approximate by design): rows-only."""
    from parchment.sources.tables import read_table
    return gov.near_duplicate_clusters(read_table(spark, sf, "documents"))


Q.cte("chunks_200", ("documents_built", "extracted"), Q.chunk_sql(200, 40))


@register("stale_embeddings", Q.with_ctes("""
  SELECT c.chunk_id, c.chunk_hash AS stored_chunk_hash, n.chunk_hash AS current_chunk_hash
  FROM chunks c JOIN chunks_200 n USING (chunk_id) WHERE c.chunk_hash <> n.chunk_hash""", "chunks", "chunks_200"))
def q_stale_embeddings(spark, sf):
    """Chunks re-cut at 200/40 words; embeddings of the 220/40 cut whose chunk changed are stale."""
    emb = _embeddings(spark, sf, EMBEDDING_MODEL)
    rechunked = chunking.build_chunks(chunking.pending_chunks(corpus.corpus_documents(spark, sf),
                                                              corpus.corpus_extracted(spark, sf)), 200, 40)
    st = embedding.stale_embeddings(emb, rechunked)
    return st.select("chunk_id", F.col("chunk_hash").alias("stored_chunk_hash"), "current_chunk_hash")


@register("chunk_rules", Q.with_ctes("""
  SELECT n AS checked, rule_name, failed FROM (
    SELECT count(*) FILTER (WHERE NOT (word_count >= 1 AND word_count <= 220)) AS chunk_words_in_range,
           count(*) FILTER (WHERE NOT (coalesce(length(chunk_text), 0) > 0)) AS chunk_text_present,
           count(*) FILTER (WHERE NOT (chunk_hash = sha256(chunk_text))) AS chunk_hash_matches,
           count(*) FILTER (WHERE NOT (character_count = length(chunk_text))) AS character_count_matches,
           count(*) AS n FROM chunks)
  UNPIVOT (failed FOR rule_name IN (chunk_words_in_range, chunk_text_present, chunk_hash_matches,
                                    character_count_matches))""", "chunks"))
def q_chunk_rules(spark, sf):
    return gov.chunk_rule_counts(corpus.corpus_chunks(spark, sf), 220)


@register("agency_norm", Q.with_ctes("""
  SELECT source_id, agency, trim(regexp_replace(lower(agency), '[^a-z0-9]+', ' ', 'g')) AS agency_key,
         (trim(source_name) <> '' AND trim(agency) <> '' AND trim(source_url) <> '') AS metadata_complete
  FROM registry""", "registry"))
def q_agency_norm(spark, sf):
    return gov.normalise_metadata(fixtures.registry(spark, sf))


@register("version_diff", Q.with_ctes("""
  SELECT source_id, version_number, CAST(sum(greatest(coalesce(c, 0) - coalesce(p, 0), 0)) AS BIGINT) AS added_chunks,
         CAST(sum(greatest(coalesce(p, 0) - coalesce(c, 0), 0)) AS BIGINT) AS removed_chunks
  FROM (SELECT coalesce(a.source_id, b.source_id) AS source_id, coalesce(a.version_number, b.version_number) AS version_number,
               a.c, b.p
        FROM (SELECT d.source_id, d.version_number, c.chunk_hash, count(*) AS c FROM chunks c JOIN documents_built d USING (document_id) GROUP BY ALL) a
        FULL OUTER JOIN (SELECT d.source_id, d.version_number + 1 AS version_number, c.chunk_hash, count(*) AS p
                         FROM chunks c JOIN documents_built d USING (document_id) GROUP BY ALL) b
          ON a.source_id = b.source_id AND a.version_number = b.version_number AND a.chunk_hash = b.chunk_hash)
  WHERE (source_id, version_number) IN (SELECT (source_id, version_number) FROM documents_built WHERE version_number > 1)
  GROUP BY source_id, version_number""", "chunks", "documents_built"))
def q_version_diff(spark, sf):
    return gov.version_diff(corpus.corpus_chunks(spark, sf), corpus.corpus_documents(spark, sf))


@register("lineage_events", Q.with_ctes(f"""
  SELECT CAST(event_id AS VARCHAR) AS input_id, 'extract' AS step, extracted_text_id AS output_id FROM extracted
  UNION ALL SELECT extracted_text_id, 'build_document', document_id FROM documents_built
  UNION ALL SELECT document_id, 'chunk', chunk_id FROM chunks
  UNION ALL SELECT chunk_id, 'embed', sha256('embedding:' || chunk_id || ':{EMBEDDING_MODEL}') FROM chunks""",
                                        "extracted", "documents_built", "chunks"))
def q_lineage_events(spark, sf):
    return gov.lineage_edges(corpus.corpus_events(spark, sf), corpus.corpus_extracted(spark, sf),
                             corpus.corpus_documents(spark, sf), corpus.corpus_chunks(spark, sf),
                             _embeddings(spark, sf, EMBEDDING_MODEL))


@register("weak_citations", Q.with_ctes(f"""
  SELECT query_id, count(*) AS results,
         count(*) FILTER (WHERE hybrid_score < 0.3 OR keyword_score <= 0) AS weak_results,
         round(avg(hybrid_score), 6) AS mean_hybrid_score, round(min(hybrid_score), 6) AS min_hybrid_score
  FROM ({_topk_sql('round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC')}) GROUP BY query_id""", "scored"))
def q_weak_citations(spark, sf):
    w = gov.weak_citations(_result_log(spark, sf))
    return _round_cols(w, ["mean_hybrid_score", "min_hybrid_score"])


# ------------------------------------------------------------ streaming
@register("stream_changes", Q.with_ctes("""
  SELECT event_id, source_id, status, previous_hash FROM fetch_classified""", "fetch_classified"))
def q_stream_changes(spark, sf):
    """Four runs over a filling landing folder give the same statuses as the batch scan."""
    import uuid

    from parchment.streaming.changes import run_change_detection
    work = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    out = run_change_detection(spark, fixtures.fetch_log(spark, sf), work)
    return out.select("event_id", "source_id", "status", "previous_hash")


# ------------------------------------------------------------ more retrieval forms
@register("hybrid_filtered", Q.with_ctes(_result_sql(_topk_sql(
    "round(hybrid_score, 9) DESC, round(vector_similarity, 9) DESC",
    "WHERE topic ILIKE '%topic (1)%' AND document_type ILIKE '%html%'")), "scored"))
def q_hybrid_filtered(spark, sf):
    """the same query table with topic and document-type filters on every query."""
    q = corpus.benchmark_queries(spark, sf).withColumn("topic", F.lit(" topic (1) ")) \
        .withColumn("document_type", F.lit("html"))
    r = retrieval.retrieve(_sha_index(spark, sf), q, "hybrid", 5, SHA_EMBEDDING_MODEL, _sha_postings(spark, sf))
    return _result_select(r)


@register("dense_cosine_topk", """
  WITH v AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
  c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS cx FROM v GROUP BY label, i),
  dots AS (SELECT c.label AS query_id, v.vec_id, sum(CAST(v.x AS DOUBLE) * c.cx) AS dot FROM v JOIN c USING (i) GROUP BY ALL),
  vn AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS n FROM v GROUP BY vec_id),
  cn AS (SELECT label, sqrt(sum(cx * cx)) AS n FROM c GROUP BY label),
  s AS (SELECT d.query_id, d.vec_id, CASE WHEN vn.n * cn.n = 0 THEN 0.0 ELSE d.dot / (vn.n * cn.n) END AS sim
        FROM dots d JOIN vn USING (vec_id) JOIN cn ON cn.label = d.query_id)
  SELECT query_id AS label, CAST(rank AS INTEGER) AS rank, vec_id, round(sim, 6) AS similarity
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, vec_id) AS rank FROM s)
  WHERE rank <= 5""")
def q_dense_cosine_topk(spark, sf):
    """C13 on given dense vectors: the 5 vectors closest to each label's centroid.

    Centroids are a (label, slot) aggregation; the bounded centroid table is
    scored against all vectors by the map-side partial top-k pass.
    """
    vec = fixtures.vectors(spark, sf)
    slots = vec.select("label", F.posexplode("embedding").alias("i", "x"))
    cent = (slots.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("cx"))
            .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "cx"))).alias("_c")))
    asked = cent.select(F.col("label").alias("query_id"), F.transform("_c", lambda s: s["cx"]).alias("query_embedding"))
    index = vec.select("vec_id", "embedding", F.col("vec_id").alias("chunk_id"),
                       F.lit("").alias("document_id"), F.col("vec_id").alias("chunk_index"))
    parts = [retrieval.score_against(index, block.collect(), 5, ("vec_id", "chunk_id", "document_id", "chunk_index"),
                                     vec.schema["label"].dataType)  # a block holds at most MAX_QUERIES_PER_PASS rows
             for block in retrieval.query_passes(asked)]
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    top = retrieval.top_k_per_query(cand, [F.round("vector_similarity", 9).desc(), F.col("vec_id")], 5)
    return top.select(F.col("query_id").alias("label"), "rank", "vec_id", r6("vector_similarity").alias("similarity"))



@register("extraction_summary", Q.with_ctes("""
  SELECT extraction_status, extraction_method, count(*) AS objects,
         CAST(sum(character_count) AS BIGINT) AS characters FROM extracted GROUP BY ALL""", "extracted"))
def q_extraction_summary(spark, sf):
    """Extraction outcome counters."""
    ex = corpus.corpus_extracted(spark, sf)
    return ex.groupBy("extraction_status", "extraction_method").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("character_count").cast("long").alias("characters"))
