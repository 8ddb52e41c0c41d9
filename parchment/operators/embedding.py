"""Chunk embeddings and the search index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.constants import EMBEDDING_DIMENSION, EMBEDDING_MODEL, HYBRID_PREVIEW_CHARS
from parchment.functions.embedding import embed
from parchment.operators.joins import narrow_side


def pending_embeddings(chunks: DataFrame, embeddings: DataFrame | None,
                       model: str = EMBEDDING_MODEL) -> DataFrame:
    """Chunks without an embedding under ``model`` (the hash is not compared, B12)."""
    if embeddings is None:
        return chunks
    done = embeddings.where(F.col("embedding_model") == model).select("chunk_id")
    return chunks.join(done, "chunk_id", "left_anti")


def embed_chunks(chunks: DataFrame, model: str = EMBEDDING_MODEL,
                 dimension: int = EMBEDDING_DIMENSION) -> DataFrame:
    """``chunk_embeddings`` rows (map-only pandas UDF, Arrow batches)."""
    return chunks.select(
        F.sha2(F.concat_ws(":", F.lit("embedding"), F.col("chunk_id"), F.lit(model)), 256).alias("embedding_id"),
        "chunk_id", "document_id", "source_id",
        F.lit(model).alias("embedding_model"),
        F.lit(dimension).alias("embedding_dimension"),
        embed(F.col("chunk_text"), model, dimension).alias("embedding"),
        "chunk_hash", "created_at")


def search_index(chunks: DataFrame, documents: DataFrame, model: str = EMBEDDING_MODEL,
                 dimension: int = EMBEDDING_DIMENSION, embeddings: DataFrame | None = None) -> DataFrame:
    """J8 denormalised once: chunk + citation metadata + vector, one row per chunk.

    Retrieval then scans this one table (twice: vectors, postings) and never
    joins the big chunk table again.  With ``embeddings`` given, stored
    vectors are used (J8 as in the reference); otherwise they are computed
    from the chunk text in the same map stage.
    """
    docs = documents.select("document_id", "title", "agency", "topic", "document_type", "source_url",
                            "version_number", "document_status")
    base = chunks.select("chunk_id", "document_id", "source_id", "chunk_index", "word_count", "chunk_text")
    if embeddings is not None:
        emb = embeddings.where(F.col("embedding_model") == model).select("chunk_id", "embedding")
        base = base.join(emb, "chunk_id", "inner")
    rows = base.join(narrow_side(docs), "document_id", "inner")
    if embeddings is None:  # after the join, which then moves no vectors
        rows = rows.withColumn("embedding", embed(F.col("chunk_text"), model, dimension))
    rows = rows.select(*[c for c in base.columns if c != "embedding"], "embedding", *[c for c in docs.columns if c != "document_id"])
    return with_preview(rows).withColumn("embedding_model", F.lit(model))


def with_preview(rows: DataFrame) -> DataFrame:
    return rows.withColumn("preview", F.substring("chunk_text", 1, HYBRID_PREVIEW_CHARS))


def stale_embeddings(embeddings: DataFrame, chunks: DataFrame) -> DataFrame:
    """Embeddings whose stored chunk hash differs from the chunk's current hash."""
    cur = chunks.select("chunk_id", F.col("chunk_hash").alias("current_chunk_hash"))
    return (embeddings.join(cur, "chunk_id", "inner")
            .where(F.col("chunk_hash") != F.col("current_chunk_hash"))
            .select("embedding_id", "chunk_id", "embedding_model", "chunk_hash", "current_chunk_hash"))
