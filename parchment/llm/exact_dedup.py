"""Exact deduplication by Golomb-coded fingerprint exchange.

1. A narrow table holds (doc_id, SHA-256 of the normalised text) in row order.
   Stretches of ``SENDER_ROWS`` rows are the senders.
2. Each sender sends its sorted distinct 64-bit fingerprints, Golomb-coded, to
   the owners of their ranges; owners answer bitmaps of those seen elsewhere.
3. Rows whose bit is set, or that repeat within their sender, are suspects.
   Only their texts are shuffled: they are grouped by the text itself, byte by
   byte, so equality never rests on a hash.  Two texts with one SHA-256 would
   stop the job rather than merge.

A group of copies of any size is one entry per sender in the exchange and
pre-aggregates before both groupings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm import exchange
from parchment.llm.common import NO_ID, row_order, stage, whole

SENDER_ROWS_LOG2 = 17
_BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> F.Column:
    """Every run of blanks becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _BLANKS, " ")


def _sha(norm: F.Column) -> F.Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def _fingerprint(sha: pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(sha.to_pylist())
    return np.frombuffer(raw, ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)


def _suspects(rows: DataFrame, n_rows: int) -> DataFrame:
    bits = exchange.owner_bits(n_rows)

    def ask(t: pa.Table) -> pa.Table:
        values = np.unique(_fingerprint(t["sha"]))
        return pa.Table.from_batches([exchange.requests(t["block"][0].as_py(), values, bits)])

    def judge(own: pa.Table, replies: pa.Table) -> pa.Table:
        values, inverse, counts = np.unique(_fingerprint(own["sha"]), return_inverse=True, return_counts=True)
        hit = exchange.answers(replies, 0, values, bits) > 0
        return own.drop_columns(["block"]).append_column("suspect", pa.array((hit | (counts > 1))[inverse]))

    replies = exchange.shared(rows.groupBy("block").applyInArrow(ask, exchange.REQUEST), bits)
    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        judge, "uid long, doc_id long, sha binary, suspect boolean")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (hex): one row per row of ``docs``.

    Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]``
    became one space.  The row with the smallest doc_id of a group stays.
    Null text: empty.  Null doc_id: larger than any other (keep_id is null
    only if all of a group are).  Rows that repeat both doc_id and text:
    exactly one of them stays.  Empty table: empty result.  Other columns of
    ``docs`` are not read.
    """
    norm = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(text).alias("norm"))
    rows = stage(
        norm.select(F.monotonically_increasing_id().alias("uid"), "doc_id", _sha(F.col("norm")).alias("sha"))
        .withColumn("block", F.shiftright("uid", SENDER_ROWS_LOG2)), "dedup-rows")
    marked = stage(_suspects(rows, rows.count()), "dedup-marked")
    suspects = marked.where("suspect")

    # Shuffle only the suspects' texts and compare them byte by byte.
    who = suspects.select(F.col("doc_id").alias("s_id"), F.col("sha").alias("s_sha")).distinct()
    texts = norm.withColumn("sha", _sha(F.col("norm"))).join(
        who, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("sha") == F.col("s_sha")), "left_semi")
    checked = (texts.groupBy("sha", "norm").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("sha").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_texts"))
               .select(F.col("sha").alias("c_sha"), F.when(
                   F.col("n_texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long")).alias("n")))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("order"), "uid", "doc_id"))
    # Written, so that the join below deals both sides itself and can split a large group.
    keepers = stage(suspects.groupBy("sha").agg(first.alias("keep")).join(checked, F.col("sha") == F.col("c_sha")).select(
        F.col("sha").alias("g_sha"), "keep", "n"), "dedup-keepers")
    found = suspects.join(keepers, F.col("sha") == F.col("g_sha"), "left").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("keep.uid") == F.col("uid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    alone = marked.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return alone.unionByName(found)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all columns, whatever their names.

    Of rows that repeat both doc_id and text, but differ elsewhere, the one with the smallest row hash stays.
    """
    kept = exact_dedup(docs, doc_id, text).where("kept").select(
        F.col("doc_id").alias("k_id"), F.unhex("text_sha256").alias("k_sha"))
    rows = whole(docs, id=F.col(doc_id).cast("long"), sha=_sha(normalised(text)), place=row_order(docs))
    return (rows.join(kept, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("sha") == F.col("k_sha")), "left_semi")
            .groupBy("id", "sha").agg(F.min_by("row", "place").alias("row")).select("row.*"))
