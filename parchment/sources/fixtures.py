"""Pipeline inputs derived from the landed test tables.

The reference fetches documents over HTTP; here the objects are already
landed, so every input of the pipeline is a DataFrame derived from the
given tables (the derivation grows with them):

* ``registry``      sources registry, one row per distinct ``documents.source``
* ``fetch_log``     fetch attempts derived from ``events`` (errors are failed fetches)
* ``landed``        one landed object per ``documents`` row, in doc_id order per source
* ``raw_html``      raw web pages (``pages``)
* ``raw_pages``     paged objects (``conversations``: object = conv_id, page = turn)
* ``questions``     golden questions from ``benchmark`` (gold = documents containing the passage)
* ``vectors``       dense vectors (``embeddings``)
* ``labelled``      ``labels`` joined to ``documents`` for classifier training
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.functions.text import sha256_hex, words
from parchment.operators.joins import MAX_BROADCAST_ROWS, bounded_broadcast
from parchment.session import AS_OF, materialize
from parchment.sources.tables import read_table

# Fixed fixture rules (see SURVEY §7.4).
REFRESH_BY_MOD4 = ("daily", "weekly", "monthly", "manual")


def _source_number(col: str = "source_id") -> F.Column:
    return F.regexp_extract(F.col(col), r"(\d+)$", 1).cast("int")


def registry_from_ids(ids: DataFrame) -> DataFrame:
    """Registry rows for a table of ``source_id`` values named ``src<N>``."""
    n = _source_number()
    stype = F.when(n % 4 == 2, "pdf").when(n % 4 == 3, "api").otherwise("html")
    url_tail = (F.when(stype == "pdf", F.lit("/report.pdf"))
                .when(stype == "api", F.lit("/v3/"))
                .otherwise(F.lit("/index.html")))
    return ids.select(
        F.col("source_id"),
        F.concat(F.lit("Source "), n.cast("string")).alias("source_name"),
        F.concat(F.lit("https://agency"), (n % 5).cast("string"), F.lit(".example.gov/"),
                 F.col("source_id"), url_tail).alias("source_url"),
        stype.alias("source_type"),
        F.concat(F.lit("Agency ("), (n % 5).cast("string"), F.lit(")")).alias("agency"),
        F.concat(F.lit("Domain ("), (n % 2).cast("string"), F.lit(")")).alias("domain"),
        F.concat(F.lit("topic ("), (n % 3).cast("string"), F.lit(")")).alias("topic"),
        F.when(stype == "api", "api_query").otherwise("http_get").alias("fetch_method"),
        F.element_at(F.array(*[F.lit(x) for x in REFRESH_BY_MOD4]), (n % 4 + 1)).alias("refresh_policy"),
        (F.lit(10) * (n % 4) + 10).cast("int").alias("priority"),
        (n % 7 != 0).alias("is_active"),
        F.lit(None).cast("string").alias("current_hash"),
        F.lit(None).cast("timestamp").alias("last_fetch_at"),
        F.when(n % 7 != 0, "not_started").otherwise("disabled").alias("last_status"),
        F.lit(None).cast("int").alias("last_http_status"),
        F.lit(None).cast("string").alias("last_error"),
        F.lit(None).cast("string").alias("notes"),
        F.lit(AS_OF).cast("timestamp").alias("created_at"),
        F.lit(AS_OF).cast("timestamp").alias("updated_at"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read_table(spark, sf_dir, "documents").select(F.col("source").alias("source_id")).distinct()
    return registry_from_ids(ids)


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch attempt per event; ``error`` events failed, others carry a content hash.

    The hash is that of ``k % 5`` (from the JSON props), so repeats are common.
    Sources are ``src<user_id % 20>``, matching the registry.
    """
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    failed = F.col("event_type") == "error"
    return ev.select(
        F.col("event_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source_id"),
        F.col("ts").alias("fetched_at"),
        F.when(failed, F.lit(None).cast("int")).otherwise(F.lit(200)).alias("http_status"),
        F.when(failed, F.lit(None).cast("string")).otherwise(F.sha2((k % 5).cast("string"), 256)).alias("content_hash"),
        F.when(failed, F.lit("fetch error")).otherwise(F.lit(None).cast("string")).alias("error_message"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed objects: each documents row is one fetched object of its source."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("event_id"),
        F.col("source").alias("source_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("doc_id").cast("decimal(18,6)"))).alias("fetched_at"),
        F.lit(200).alias("http_status"),
        sha256_hex("text").alias("content_hash"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("error_message"),
    )


def raw_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(F.col("conv_id").alias("object_id"), F.col("turn").alias("page_no"),
                       F.col("text").alias("page_text"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return lab.join(docs, "doc_id", "inner")


def _hash_of_three(words: str, at: F.Column) -> F.Column:
    """The hash of the three words from place ``at`` on (from 0)."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(3)])


# Passages without a word that must stand whole in a document are tested in blocks of this many.
_SHORT_BLOCK = 1024


def passage_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, doc_id) for every document that contains a benchmark passage verbatim."""
    return contained_passages(read_table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage")),
                              read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def contained_passages(bench: DataFrame, docs: DataFrame) -> DataFrame:
    """(item_id, doc_id) for every text of ``docs`` that contains a ``passage`` of ``bench`` verbatim.

    A substring test between two tables is a theta join; instead every
    passage contributes an anchor of whole words that any containing document
    must hold as consecutive words (its 2nd-4th words; the first and last may
    be cut).  Documents' word trigrams, hashed, are equi-joined to the hashed
    anchors and each candidate is then verified with ``instr`` on the whole
    texts (so hash collisions cannot add a match).  Passages of one or two
    words have no word that must stand whole: they are looked for in every
    text, a block of passages at a time.  A null passage or one without a word
    is in no document, a null text contains nothing.
    """
    bw = bench.where(F.col("passage").isNotNull()).withColumn("_w", words("passage")).withColumn("_m", F.size("_w"))
    anchors = bw.where("_m >= 3").select(
        "item_id",
        F.when(F.col("_m") >= 5, _hash_of_three("_w", F.lit(1)))
         .otherwise(F.xxhash64(F.try_element_at("_w", F.lit(2)))).alias("anchor"),
        F.when(F.col("_m") >= 5, F.lit(3)).otherwise(F.lit(1)).alias("anchor_len"))
    docs = docs.where(F.col("text").isNotNull())
    dw = docs.select("doc_id", words("text").alias("_w"))
    # word trigrams are hashed where they stand in the array (no self-join, no text of their own)
    at = F.when(F.size("_w") >= 3, F.sequence(F.lit(0), F.size("_w") - 3))
    tri3 = dw.select("doc_id", F.explode(F.transform(at, lambda i: _hash_of_three("_w", i))).alias("anchor"))
    small = bounded_broadcast(anchors, MAX_BROADCAST_ROWS)
    cand = tri3.join(small.where("anchor_len = 3"), "anchor").select("item_id", "doc_id")
    if anchors.where("anchor_len = 1").limit(1).count() > 0:
        uni = dw.select("doc_id", F.explode(F.array_distinct(F.transform("_w", lambda x: F.xxhash64(x))))
                        .alias("anchor"))
        cand = cand.unionByName(
            uni.join(small.where("anchor_len = 1"), "anchor").select("item_id", "doc_id"))
    # few, and written once: where they are proven few, the texts stay where they are
    cand = bounded_broadcast(materialize(cand.distinct(), "anchored"), MAX_BROADCAST_ROWS)
    found = (docs.join(cand, "doc_id").join(bounded_broadcast(bench, MAX_BROADCAST_ROWS), "item_id")
             .where(F.instr(F.col("text"), F.col("passage")) > 0)).select("item_id", "doc_id")
    short = bw.where("_m BETWEEN 1 AND 2").select("item_id", "passage")
    for block in _blocks(short, "item_id"):
        asked = F.array(*[F.struct(F.lit(r["item_id"]).alias("item_id"), F.lit(r["passage"]).alias("passage")) for r in block])
        held = F.filter(asked, lambda q: F.contains(F.col("text"), q["passage"]))
        found = found.unionByName(docs.select(F.explode(held).alias("q"), "doc_id").select("q.item_id", "doc_id"))
    return found


def _blocks(rows: DataFrame, key: str):
    """The rows in blocks of at most ``_SHORT_BLOCK``, one block on the driver at a time."""
    block = rows.orderBy(key, "passage").limit(_SHORT_BLOCK).collect()
    while block:
        yield block
        last = block[-1]
        after = (F.col(key) > last[key]) | ((F.col(key) == last[key]) & (F.col("passage") > last["passage"]))
        block = rows.where(after).orderBy(key, "passage").limit(_SHORT_BLOCK).collect()
