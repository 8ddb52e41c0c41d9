"""Document build: quality rules, readiness, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.constants import DOCUMENT_MIN_CHARACTERS, DOCUMENT_MIN_WORDS
from parchment.functions.text import strip_ws
from parchment.operators.joins import bounded_broadcast, narrow_side
from parchment.operators.scan import row_number_by

DOCUMENT_COLUMNS = ("document_id", "source_id", "event_id", "extracted_text_id", "title", "source_url",
                    "agency", "domain", "topic", "document_type", "content_hash", "version_number",
                    "document_status", "character_count", "word_count", "created_at", "updated_at")


def pending_documents(extracted: DataFrame, registry: DataFrame, events: DataFrame,
                      documents: DataFrame | None = None) -> DataFrame:
    """Extractions (success|quarantined) with a hash and no document yet."""
    reg = registry.select("source_id", "source_name", "source_url", "source_type", "agency", "domain", "topic")
    ev = events.select("event_id", "content_hash")
    rec = (extracted.where(F.col("extraction_status").isin("success", "quarantined"))
           .join(narrow_side(ev), "event_id", "inner")
           .where(F.col("content_hash").isNotNull())
           .join(bounded_broadcast(reg), "source_id", "inner"))
    if documents is not None:
        rec = rec.join(documents.select("source_id", "content_hash"), ["source_id", "content_hash"], "left_anti")
    return rec


def _rule_array(min_characters: int, min_words: int) -> F.Column:
    """The seven rules of one record as an array of structs (all severity ``error``)."""
    def rule(name, passed, message, measured):
        return F.struct(F.lit(name).alias("rule_name"), F.lit("error").alias("severity"),
                        passed.alias("passed"), F.lit(message).alias("message"),
                        measured.cast("string").alias("measured_value"))

    def present(c):
        return F.coalesce(strip_ws(F.col(c)) != "", F.lit(False))

    return F.array(
        rule("title_present", present("source_name"), "Document title/source name is present.",
             F.col("source_name")),
        rule("agency_present", present("agency"), "Agency metadata is present.", F.col("agency")),
        rule("source_url_present", present("source_url"), "Source URL is present.", F.col("source_url")),
        rule("content_hash_present", F.coalesce(F.col("content_hash") != "", F.lit(False)),
             "Content hash is present for version tracking.", F.coalesce(F.col("content_hash"), F.lit(""))),
        rule("extraction_success", F.coalesce(F.col("extraction_status") == "success", F.lit(False)),
             "Text extraction completed successfully.", F.col("extraction_status")),
        rule("minimum_character_count", F.col("character_count") >= min_characters,
             f"Extracted text has at least {min_characters} characters.", F.col("character_count")),
        rule("minimum_word_count", F.col("word_count") >= min_words,
             f"Extracted text has at least {min_words} words.", F.col("word_count")),
    )


def quality_rules(records: DataFrame, min_characters: int = DOCUMENT_MIN_CHARACTERS,
                  min_words: int = DOCUMENT_MIN_WORDS) -> DataFrame:
    """Seven error-severity rules per record, in long form (one row per rule)."""
    return records.select("extracted_text_id", "source_id", "content_hash",
                          F.inline(_rule_array(min_characters, min_words)))


def readiness(records: DataFrame, min_characters: int = DOCUMENT_MIN_CHARACTERS,
              min_words: int = DOCUMENT_MIN_WORDS) -> DataFrame:
    """Status (quarantined if any error rule fails) and failed rule names.

    Computed per row from an array of rule structs: no shuffle.
    """
    with_rules = records.withColumn("_rules", _rule_array(min_characters, min_words))
    failed = F.filter("_rules", lambda r: ~r["passed"])
    return (with_rules
            .withColumn("document_status",
                        F.when(F.exists("_rules", lambda r: (~r["passed"]) & (r["severity"] == "error")),
                               "quarantined").otherwise("ai_ready"))
            .withColumn("failed_rules", F.coalesce(
                F.nullif(F.array_join(F.transform(failed, lambda r: r["rule_name"]), ","), F.lit("")),
                F.lit("-")))
            .drop("_rules"))


def document_key(source_id, content_hash) -> F.Column:
    return F.sha2(F.concat_ws(":", F.lit("document"), source_id, content_hash), 256)


def build_documents(records: DataFrame, existing: DataFrame | None = None,
                    min_characters: int = DOCUMENT_MIN_CHARACTERS,
                    min_words: int = DOCUMENT_MIN_WORDS) -> DataFrame:
    """New document versions from pending records.

    Per (source, hash) the first extraction fixes the version and creation
    time, the last one supplies every other field (upsert: last wins).  New
    versions are numbered ``max(existing version) + row_number`` per source
    in order of first extraction; the numbering scan is skew-safe.  Texts stay
    out of the shuffle; chunking joins them back by ``extracted_text_id`` (J5).
    """
    rec = readiness(records, min_characters, min_words)
    order = F.struct("extracted_at", "extracted_text_id")
    per_key = rec.groupBy("source_id", "content_hash").agg(
        F.min(order).alias("_first"),
        F.max_by(F.struct(*[c for c in rec.columns
                            if c not in ("source_id", "content_hash", "extracted_text")]), order).alias("_l"))
    flat = per_key.select("source_id", "content_hash", F.col("_first.extracted_at").alias("first_at"),
                          F.col("_first.extracted_text_id").alias("first_id"), "_l.*")
    if existing is not None:
        base = existing.groupBy("source_id").agg(F.max("version_number").alias("_base"))
        flat = flat.join(base, "source_id", "left")
    else:
        flat = flat.withColumn("_base", F.lit(None).cast("int"))
    numbered = row_number_by(flat, ["source_id"], ["first_at", "first_id"], "version_number",
                             offset=F.coalesce(F.col("_base"), F.lit(0)))
    return numbered.select(
        document_key(F.col("source_id"), F.col("content_hash")).alias("document_id"),
        "source_id", "event_id", "extracted_text_id",
        F.col("source_name").alias("title"), "source_url", "agency", "domain", "topic",
        F.col("source_type").alias("document_type"), "content_hash", "version_number",
        "document_status", "character_count", "word_count",
        F.col("first_at").alias("created_at"), F.col("extracted_at").alias("updated_at"),
        "failed_rules")
