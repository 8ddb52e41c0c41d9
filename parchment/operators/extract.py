"""Text extraction (D2 HTML, D3 page assembly, D4 routing/quarantine, J2 pending)."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from parchment.constants import EXTRACT_MIN_CHARACTERS
from parchment.functions.text import normalize_lines
from parchment.operators.joins import bounded_broadcast

# --- fixed values: HTML handling --------------------------------------------
# Elements whose content is dropped entirely.
DROPPED_ELEMENTS = ("script", "style", "noscript")
TAG_PATTERN = r"(?s)<!--.*?(?:-->|\z)|<[A-Za-z/!?][^>]*>"


@F.pandas_udf(StringType())
def decode_references(texts: pd.Series) -> pd.Series:
    """Every HTML character reference, named, decimal or hexadecimal, decoded once (``&amp;lt;`` gives ``&lt;``)."""
    return texts.map(lambda t: html.unescape(t) if t and "&" in t else t)


_BLANKS = re.compile("\t[ \t]*| [ \t]+")  # the runs that are not one space already


@F.pandas_udf(StructType([StructField("extracted_text", StringType()), StructField("word_count", IntegerType())]))
def clean_text(texts: pd.Series, markup: pd.Series) -> pd.DataFrame:
    """C6 and C8 of whole texts, each read once; references are decoded where the text was ``markup``."""
    def cleaned(text, is_markup):
        if is_markup and "&" in text:
            text = html.unescape(text)
        return _BLANKS.sub(" ", "\n".join(x for line in text.splitlines() if (x := line.strip())))
    lines = [None if t is None else cleaned(t, m) for t, m in zip(texts, markup)]
    return pd.DataFrame({"extracted_text": pd.Series(lines, dtype=object), "word_count": [len((t or "").split()) for t in lines]})


def without_markup(col) -> F.Column:
    """Script/style/noscript blocks dropped, tags turned into line breaks.

    A block or a comment that is never closed reaches to the end of the page.
    """
    whole = c = F.col(col) if isinstance(col, str) else col
    for el in DROPPED_ELEMENTS:
        c = F.regexp_replace(c, rf"(?is)<{el}\b.*?(?:</{el}\s*>|\z)", " ")
    # every pattern begins with "<": a text without one stays as it is
    return F.when(F.contains(whole, F.lit("<")), F.regexp_replace(c, TAG_PATTERN, "\n")).otherwise(whole)


def html_to_text(col) -> F.Column:
    """Markup dropped, references decoded, C6."""
    return normalize_lines(decode_references(without_markup(col)))


def decode_utf8_lenient(binary_col) -> F.Column:
    """Bytes -> text, dropping undecodable bytes (``errors='ignore'``)."""
    c = F.col(binary_col) if isinstance(binary_col, str) else binary_col
    return F.replace(F.make_valid_utf8(c.cast("string")), F.lit("�"), F.lit(""))


def assemble_pages(pages: DataFrame, key: str = "object_id", page: str = "page_no",
                   text: str = "page_text") -> DataFrame:
    """D3: one text per object: its page texts in page order, joined by newline, then C6."""
    grouped = pages.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))).alias("_pages"),
        F.count(F.lit(1)).cast("int").alias("page_count"))
    joined = F.array_join(F.transform("_pages", lambda x: F.coalesce(x["t"], F.lit(""))), "\n")
    return grouped.select(key, "page_count", normalize_lines(joined).alias("extracted_text"))


def route_extraction(df: DataFrame, source_type: str = "source_type", raw_text: str = "raw_text",
                     min_characters: int = EXTRACT_MIN_CHARACTERS) -> DataFrame:
    """Method by source type; unsupported types fail; short texts are quarantined.

    ``raw_text`` is the decoded object: HTML markup for ``html`` sources and
    the concatenated page text for ``pdf`` sources.
    """
    st = F.col(source_type)
    method = F.when(st == "html", "html_text").when(st == "pdf", "pdf_text").otherwise("unsupported")
    raw = F.when(st == "html", without_markup(raw_text)).when(st == "pdf", F.col(raw_text))
    out = (df.withColumn("extraction_method", method).withColumn("_cleaned", clean_text(raw, F.coalesce(st == "html", F.lit(False))))
           .withColumn("extracted_text", F.col("_cleaned.extracted_text")))
    chars = F.coalesce(F.length("extracted_text"), F.lit(0)).cast("int")
    out = out.withColumn("character_count", chars).withColumn("word_count", F.col("_cleaned.word_count")).drop("_cleaned")
    status = (F.when(F.col("extraction_method") == "unsupported", "failed")
              .when(F.col("character_count") < min_characters, "quarantined")
              .otherwise("success"))
    error = (F.when(F.col("extraction_method") == "unsupported",
                    F.concat(F.lit("Unsupported source_type for extraction: "), st))
             .when(F.col("character_count") < min_characters,
                   F.format_string("Extracted text too short: %d characters, minimum is %d",
                                   F.col("character_count"), F.lit(min_characters))))
    return out.withColumn("extraction_status", status).withColumn("error_message", error)


def pending_extraction(events: DataFrame, registry: DataFrame, extracted: DataFrame) -> DataFrame:
    """Successful events with an object, not yet extracted, oldest first."""
    reg = registry.select("source_id", "source_name", "source_type")
    todo = (events.where((F.col("status") == "success") & F.col("object_path").isNotNull())
            .join(bounded_broadcast(extracted.select("event_id")), "event_id", "left_anti")
            .join(bounded_broadcast(reg), "source_id", "inner"))
    return todo


def extract_events(pending: DataFrame, raw_text: str = "content",
                   min_characters: int = EXTRACT_MIN_CHARACTERS) -> DataFrame:
    """D4 over pending events -> ``extracted_text`` rows with deterministic ids."""
    routed = route_extraction(pending, "source_type", raw_text, min_characters)
    return routed.select(
        F.sha2(F.concat(F.lit("extracted:"), F.col("event_id").cast("string")), 256).alias("extracted_text_id"),
        "source_id", "event_id", "object_path", "extraction_method", "extraction_status",
        "extracted_text", "character_count", "word_count", "error_message",
        F.col("fetched_at").alias("extracted_at"))
