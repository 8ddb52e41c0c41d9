"""Overlapping word-window chunking."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parchment.constants import CHUNK_METHOD, CHUNK_WORDS, OVERLAP_WORDS
from parchment.operators.joins import narrow_side


def check_chunk_args(chunk_words: int, overlap_words: int) -> None:
    """Windows advance by ``chunk_words - overlap_words``, which must be 1 to ``chunk_words``."""
    if not 0 <= overlap_words < chunk_words:
        raise ValueError(f"windows of {chunk_words} words cannot overlap by {overlap_words}: need 0 <= overlap < window")


def chunk_count(n_words, chunk_words: int = CHUNK_WORDS, overlap_words: int = OVERLAP_WORDS) -> F.Column:
    """Number of windows: 0 for no words, else ``max(1, ceil((n - overlap) / step))``."""
    n = F.col(n_words) if isinstance(n_words, str) else n_words
    step = chunk_words - overlap_words
    return F.when(n <= 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.ceil((n - F.lit(overlap_words)) / F.lit(step)).cast("int")))


def chunk_text(df: DataFrame, text: str = "extracted_text", chunk_words: int = CHUNK_WORDS,
               overlap_words: int = OVERLAP_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per window: index from 1, start = (i-1)*step, last window ends at the text end.

    Map-only: a text is split into words (C8) once, its windows are cut from them, no shuffle.
    """
    check_chunk_args(chunk_words, overlap_words)
    texts = df.select(*keep, F.col(text).alias("_text"))
    new = [T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_text", T.StringType()), T.StructField("word_count", T.IntegerType())]
    schema = T.StructType([*[texts.schema[c] for c in keep], *new])

    def windows(batches):
        for batch in batches:
            row, index, cut, sizes = [], [], [], []
            for r, t in enumerate(batch.column("_text").to_pylist()):
                w = (t or "").split()
                starts = range(0, max(1, len(w) - overlap_words) if w else 0, chunk_words - overlap_words)
                row += [r] * len(starts)
                index += range(1, len(starts) + 1)
                cut += [" ".join(w[at:at + chunk_words]) for at in starts]
                sizes += [min(len(w) - at, chunk_words) for at in starts]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(row, pa.int64())) for c in keep],
                 pa.array(index, pa.int32()), pa.array(cut, pa.string()), pa.array(sizes, pa.int32())], schema.names)

    out = texts.mapInArrow(windows, schema)
    return (out.withColumn("chunk_hash", F.sha2("chunk_text", 256))
            .withColumn("character_count", F.length("chunk_text").cast("int")))


def chunk_key(document_id, chunk_index) -> F.Column:
    return F.sha2(F.concat_ws(":", F.lit("chunk"), document_id, chunk_index.cast("string")), 256)


def pending_chunks(documents: DataFrame, extracted: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """ai_ready documents with text and no chunks yet."""
    txt = extracted.select("extracted_text_id", "extracted_text").where(F.col("extracted_text").isNotNull())
    todo = narrow_side(documents.where(F.col("document_status") == "ai_ready")).join(txt, "extracted_text_id", "inner")
    if chunks is not None:
        todo = todo.join(narrow_side(chunks.select("document_id").distinct()), "document_id", "left_anti")
    return todo


def build_chunks(pending: DataFrame, chunk_words: int = CHUNK_WORDS, overlap_words: int = OVERLAP_WORDS,
                 created_at: str | None = None) -> DataFrame:
    """U5 rows of ``document_chunks`` for pending documents."""
    ch = chunk_text(pending, "extracted_text", chunk_words, overlap_words,
                    keep=("document_id", "source_id", "updated_at"))
    return ch.select(
        chunk_key(F.col("document_id"), F.col("chunk_index")).alias("chunk_id"),
        "document_id", "source_id", "chunk_index", "chunk_text", "chunk_hash",
        F.lit(CHUNK_METHOD).alias("chunk_method"), "character_count", "word_count",
        F.lit(None).cast("string").alias("section_heading"),
        (F.lit(created_at).cast("timestamp") if created_at else F.col("updated_at")).alias("created_at"))


def chunk_stats(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunk count and min/max words per document title."""
    return (chunks.join(documents.select("document_id", "title"), "document_id", "inner")
            .groupBy("title").agg(F.count(F.lit(1)).alias("chunks"),
                                  F.min("word_count").alias("min_words"),
                                  F.max("word_count").alias("max_words")))
