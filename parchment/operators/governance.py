"""Upserts, constraint audits, status report, logs and governance checks.

U1-U12, Q1-Q6, D14, D25, J10-J12, X2-X4, X6-X9.  Upserts are written as new
snapshots (parquet has no MERGE); "last wins" is a ``max`` over (order, row
number) alone, partial on the map side, so a key repeated in a third of the
rows does not pin one task, and texts are attached to the winners.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.constants import (DOCUMENT_STATUSES, EXTRACTION_STATUSES,
                                 FETCH_METHODS, FETCH_STATUSES, REFRESH_POLICIES, SEVERITIES, SOURCE_STATUSES,
                                 SOURCE_TYPES)
from parchment.operators.joins import bounded_broadcast, narrow_side
from parchment.session import AS_OF, materialize


# ------------------------------------------------------------------ upserts
def stage_rows(incoming: DataFrame) -> DataFrame:
    """``incoming`` written once, with a row number ``__row`` that names each row."""
    return materialize(incoming.withColumn("__row", F.monotonically_increasing_id()), "incoming")


def merge_latest(existing: DataFrame | None, staged: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row latest by ``order``; ``staged`` comes from ``stage_rows``, ``existing`` has unique keys.

    Winners are found on (keys, order) alone, so no aggregate buffer holds a
    text or a vector; the other columns are attached to them afterwards.  An
    incoming row wins ties with an existing one, and of equal incoming rows the
    last.  Null keys are equal, null orders come first.
    """
    cols = [c for c in staged.columns if c != "__row"]
    narrow = staged.select(*keys, F.struct(*order, F.col("__row")).alias("__at"))
    if existing is not None:
        stored = existing.select(*keys, F.struct(*order, F.lit(-1).cast("long").alias("__row")).alias("__at"))
        narrow = narrow.unionByName(stored)
    won = narrow.groupBy(*keys).agg(F.max("__at")["__row"].alias("__won"))
    rows = won.where("__won >= 0").select("__won")
    taken = staged.join(narrow_side(rows), F.col("__row") == F.col("__won"), "left_semi").select(*cols)
    if existing is None:
        return taken
    over = won.where("__won >= 0").select(*keys)
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    kept = existing.alias("e").join(narrow_side(over).alias("o"), same, "left_anti")
    return kept.select(*cols).unionByName(taken)


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row latest by ``order`` wins (incoming wins ties)."""
    cols = existing.columns
    return merge_latest(existing, stage_rows(incoming.select(*cols)), keys, order).select(*cols)


def upsert_keep(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Incoming overwrites existing rows except ``keep`` columns (e.g. id, version)."""
    cols = existing.columns
    kept = existing.select(*keys, *[F.col(c).alias(f"_k_{c}") for c in keep])
    merged = incoming.select(*cols).join(kept, keys, "left")
    for c in keep:
        merged = merged.withColumn(c, F.coalesce(F.col(f"_k_{c}"), F.col(c))).drop(f"_k_{c}")
    untouched = existing.join(incoming.select(*keys), keys, "left_anti")
    return untouched.select(*cols).unionByName(merged.select(*cols))


def seed_merge(existing: DataFrame, seed: DataFrame, key: str, metadata: list[str],
               reactivate: str | None = None, inserted: dict[str, F.Column] | None = None) -> DataFrame:
    """Keyed full-outer merge; seed metadata overwrites (nulls too), state columns are kept.

    A row is in the seed when it has the seed's presence mark, whatever its
    values.  ``inserted`` gives the other columns of rows that are new (their
    key, status, flags and times); without it they are null.
    """
    s = seed.select(key, F.lit(True).alias("_seeded"), *[F.col(c).alias(f"_s_{c}") for c in metadata])
    seeded, stored = F.col("_seeded").isNotNull(), F.col("_stored").isNotNull()
    out = existing.withColumn("_stored", F.lit(True)).join(s, key, "full_outer")
    new = {c: F.when(seeded, F.col(f"_s_{c}")).otherwise(F.col(c)) for c in metadata}
    for c, value in (inserted or {}).items():
        new[c] = F.when(stored, new.get(c, F.col(c))).otherwise(F.coalesce(new[c], value) if c in new else value)
    if reactivate:
        new[reactivate] = F.when(seeded, F.lit(True)).otherwise(F.col(reactivate))
    return out.withColumns(new).select(*existing.columns)


def registry_defaults(as_of: str = AS_OF) -> dict[str, F.Column]:
    """What a source has when it is first seeded: a key made of its URL, the column defaults, no fetch yet."""
    now = F.lit(as_of).cast("timestamp")
    return {"source_id": F.sha2(F.concat(F.lit("source:"), F.col("source_url")), 256), "fetch_method": F.lit("http_get"),
            "refresh_policy": F.lit("weekly"), "priority": F.lit(100), "is_active": F.lit(True),
            "last_status": F.lit("not_started"), "created_at": now, "updated_at": now}


def apply_corrections(registry: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections (source_url, action, new_url, new_type, reason) applied by a join.

    ``swap_url`` replaces the URL, the type (null keeps it) and the notes, and
    clears hash, HTTP status and error; ``disable`` deactivates the source and
    gives the reason as its last error.  The time of the last fetch stays.
    """
    c = corrections.select("source_url", "action", "new_url", "new_type", "reason")
    j = registry.join(bounded_broadcast(c), "source_url", "left")
    swap, disable = F.col("action") == "swap_url", F.col("action") == "disable"
    changed = {
        "source_url": F.when(swap, F.col("new_url")),
        "source_type": F.when(swap, F.coalesce("new_type", "source_type")),
        "notes": F.when(swap, F.col("reason")),
        "last_status": F.when(swap, F.lit("not_started")).when(disable, F.lit("disabled")),
        "last_error": F.when(swap, F.lit(None)).when(disable, F.col("reason")),
        "last_http_status": F.when(swap, F.lit(None)),
        "current_hash": F.when(swap, F.lit(None)),
        "is_active": F.when(disable, F.lit(False)),
    }
    return j.select(*[changed[x].otherwise(F.col(x)).alias(x) if x in changed else F.col(x) for x in registry.columns])


def append_new(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows are appended; one that an earlier run has appended already is not repeated."""
    cols = existing.columns
    return existing.unionByName(incoming.select(*cols).join(existing.select(key), key, "left_anti").select(*cols))


# ------------------------------------------------------------------ audits
def audit_unique(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q1: per table, keys that occur more than once (count of such keys and extra rows)."""
    parts = []
    for name, (df, keys) in tables.items():
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        parts.append(g.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("extra_rows"))
                     .select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*"))
    return reduce(DataFrame.unionByName, parts)


def audit_fk(relations: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q2: child rows whose reference has no parent row (anti-join), per relation."""
    parts = []
    for name, (child, ccol, parent, pcol) in relations.items():
        orphans = child.where(F.col(ccol).isNotNull()).join(
            parent.select(F.col(pcol).alias(ccol)), ccol, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("relation"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def audit_domain(checks: dict[str, tuple[DataFrame, str, tuple]]) -> DataFrame:
    """Q3: values outside the declared domain, per column."""
    parts = []
    for name, (df, col, allowed) in checks.items():
        parts.append(df.agg(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*allowed)).alias("violations"))
                     .select(F.lit(name).alias("column_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def audit_null(df: DataFrame, table: str, not_null: list[str]) -> DataFrame:
    """Q4: null count per declared not-null column (one pass, one row per column)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    return row.selectExpr(f"stack({len(not_null)}, {stack}) AS (column_name, nulls)").select(
        F.lit(table).alias("table_name"), "column_name", "nulls")


def audit_dimension(tables: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Q5: per table, vectors whose length differs from the declared dimension (one aggregation each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.size("embedding") != dimension).alias("violations"))
             .select(F.lit(name).alias("table_name"), "checked", "violations") for name, (df, dimension) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def cascade_delete(documents: DataFrame, dependents: dict[str, DataFrame], doomed: DataFrame) -> dict[str, DataFrame]:
    """Q6: remove documents and everything that references them (anti-joins, new snapshots)."""
    ids = doomed.select("document_id").distinct()
    out = {"documents": documents.join(ids, "document_id", "left_anti")}
    for name, df in dependents.items():
        out[name] = df.join(ids, "document_id", "left_anti")
    return out


REGISTRY_DOMAINS = {"source_type": SOURCE_TYPES, "fetch_method": FETCH_METHODS,
                    "refresh_policy": REFRESH_POLICIES, "last_status": SOURCE_STATUSES}
OTHER_DOMAINS = {"fetch_status": FETCH_STATUSES, "extraction_status": EXTRACTION_STATUSES,
                 "document_status": DOCUMENT_STATUSES, "severity": SEVERITIES}


# ------------------------------------------------------------------ logs & report
def query_log(queries: DataFrame, results: DataFrame, mode: str, model: str, started_at: F.Column) -> DataFrame:
    """One log row per query with filters as JSON (nulls kept) and result count."""
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).cast("int").alias("result_count"))
    filt = F.to_json(F.struct(*[F.col(c).alias(c) if c in queries.columns else F.lit(None).cast("string").alias(c)
                               for c in ("agency", "topic", "document_type")]),
                     {"ignoreNullFields": "false"})
    return (queries.join(counts, "query_id", "left")
            .select(F.sha2(F.concat_ws(":", F.lit("query"), F.col("query_id").cast("string"), F.lit(mode),
                                       F.lit(model)), 256).alias("log_query_id"),
                    "query_id", "query_text", F.lit(mode).alias("retrieval_mode"),
                    F.lit(model).alias("embedding_model"), filt.alias("filters"),
                    started_at.alias("started_at"),
                    F.coalesce(F.col("result_count"), F.lit(0)).alias("result_count")))


def result_log(results: DataFrame, log: DataFrame) -> DataFrame:
    """Ranked result rows keyed by the logged query id."""
    return results.join(log.select("query_id", "log_query_id"), "query_id").select(
        "log_query_id", "rank", "chunk_id", "document_id", "source_id",
        "vector_similarity", "keyword_score", "hybrid_score")


def report_sources(registry_now: DataFrame) -> DataFrame:
    """A1: sources per last status."""
    return registry_now.groupBy("last_status").agg(F.count(F.lit(1)).alias("sources"))


def report_documents(documents: DataFrame) -> DataFrame:
    """A2: documents and words per status."""
    return documents.groupBy("document_status").agg(F.count(F.lit(1)).alias("documents"),
                                                    F.sum("word_count").cast("long").alias("total_words"))


def report_coverage(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunked documents, chunks and embeddings (left join on chunk id, as reported)."""
    j = chunks.select("chunk_id", "document_id").join(embeddings.select("chunk_id", "embedding_id"), "chunk_id", "left")
    return j.agg(F.count_distinct("document_id").alias("chunked_documents"),
                 F.count("chunk_id").alias("chunks"), F.count("embedding_id").alias("embeddings"))


def latest(df: DataFrame, ts: str, n: int = 5) -> DataFrame:
    """T5: the ``n`` newest rows (TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c) for c in df.columns if c != ts]).limit(n)


# ------------------------------------------------------------------ governance extensions
def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Groups of byte-identical texts (hash groups; partial aggregation)."""
    return (docs.groupBy(F.sha2(F.col(text), 256).alias("content_hash"))
            .agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_id"))
            .where(F.col("copies") > 1))


def near_duplicate_clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                            num_hashes: int = 20, bands: int = 5) -> DataFrame:
    """Near-copies by MinHash banding, as a cluster label (no pair is emitted).

    Word shingles are exploded once; signature slot ``i`` is
    ``min(xxhash64(i, shingle))`` per document - plain aggregate expressions,
    partial on the map side and inside whole-stage codegen.  Every band of
    ``num_hashes / bands`` slots is a group key; a document's label is the
    smallest id over the groups of its bands (one hop).  Work is linear in
    the text; a hot band value is an aggregation, never a pair list.
    """
    from pyspark.ml.feature import NGram

    from parchment.functions.text import words

    w = docs.select(key, words(text).alias("_w"))
    ng = NGram(n=shingle, inputCol="_w", outputCol="_ng").transform(w)
    # a text shorter than one shingle is one shingle of all its words
    grams = F.when(F.size("_ng") > 0, F.col("_ng")).otherwise(F.array(F.array_join("_w", " ")))
    sh = (ng.select(key, F.explode(grams).alias("_g")).where(F.col("_g") != "")
          .select(key, F.xxhash64("_g").alias("_sh")))
    sig = sh.groupBy(key).agg(*[F.min(F.xxhash64(F.lit(i), F.col("_sh"))).alias(f"_m{i}")
                                for i in range(num_hashes)])
    per = num_hashes // bands
    band_values = F.array(*[F.xxhash64(*[F.col(f"_m{b * per + j}") for j in range(per)]) for b in range(bands)])
    banded = sig.select(key, F.posexplode(band_values).alias("band", "_bv"))
    groups = banded.groupBy("band", "_bv").agg(F.min(key).alias("_rep"))
    return banded.join(groups, ["band", "_bv"]).groupBy(key).agg(F.min("_rep").alias("cluster_id"))


def chunk_rule_counts(chunks: DataFrame, chunk_words: int) -> DataFrame:
    """Chunk-level rules (size within bounds, text present, hash matches text)."""
    rules = {
        "chunk_words_in_range": (F.col("word_count") >= 1) & (F.col("word_count") <= chunk_words),
        "chunk_text_present": F.coalesce(F.length("chunk_text"), F.lit(0)) > 0,
        "chunk_hash_matches": F.col("chunk_hash") == F.sha2("chunk_text", 256),
        "character_count_matches": F.col("character_count") == F.length("chunk_text"),
    }
    row = chunks.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(~c).alias(k) for k, c in rules.items()])
    stack = ", ".join(f"'{k}', `{k}`" for k in rules)
    return row.selectExpr("_n AS checked", f"stack({len(rules)}, {stack}) AS (rule_name, failed)")


def normalise_metadata(registry: DataFrame) -> DataFrame:
    """Normalised agency key and required-metadata flag per source."""
    from parchment.functions.text import collapse_ws
    norm = F.regexp_replace(F.lower(collapse_ws(F.col("agency"))), r"[^a-z0-9]+", " ")
    return registry.select(
        "source_id", "agency", F.trim(norm).alias("agency_key"),
        ((F.coalesce(F.trim(F.col("source_name")), F.lit("")) != "")
         & (F.coalesce(F.trim(F.col("agency")), F.lit("")) != "")
         & (F.coalesce(F.trim(F.col("source_url")), F.lit("")) != "")).alias("metadata_complete"))


def version_diff(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunk hashes added / removed between consecutive versions of a source (multiset)."""
    v = chunks.join(documents.select("document_id", "version_number"), "document_id").select(
        "source_id", "version_number", "chunk_hash")
    cur = v.groupBy("source_id", "version_number", "chunk_hash").agg(F.count(F.lit(1)).alias("_c"))
    prev = cur.select("source_id", (F.col("version_number") + 1).alias("version_number"), "chunk_hash",
                      F.col("_c").alias("_p"))
    versions = documents.select("source_id", "version_number").where(F.col("version_number") > 1)
    j = cur.join(prev, ["source_id", "version_number", "chunk_hash"], "full_outer") \
        .join(versions, ["source_id", "version_number"], "left_semi")
    return j.groupBy("source_id", "version_number").agg(
        F.sum(F.greatest(F.coalesce("_c", F.lit(0)) - F.coalesce("_p", F.lit(0)), F.lit(0))).cast("long").alias("added_chunks"),
        F.sum(F.greatest(F.coalesce("_p", F.lit(0)) - F.coalesce("_c", F.lit(0)), F.lit(0))).cast("long").alias("removed_chunks"))


def lineage_edges(events: DataFrame, extracted: DataFrame, documents: DataFrame, chunks: DataFrame,
                  embeddings: DataFrame) -> DataFrame:
    """One row per (input id, step, output id) from the stored keys."""
    e = lambda df, i, s, o: df.select(F.col(i).cast("string").alias("input_id"), F.lit(s).alias("step"),
                                      F.col(o).cast("string").alias("output_id"))
    return reduce(DataFrame.unionByName, [
        e(extracted, "event_id", "extract", "extracted_text_id"),
        e(documents, "extracted_text_id", "build_document", "document_id"),
        e(chunks, "document_id", "chunk", "chunk_id"),
        e(embeddings, "chunk_id", "embed", "embedding_id"),
    ])


def weak_citations(results: DataFrame, min_hybrid: float = 0.3) -> DataFrame:
    """Per query, results with weak support (low hybrid score or no keyword match)."""
    weak = (F.col("hybrid_score") < min_hybrid) | (F.col("keyword_score") <= 0)
    return results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("results"), F.count_if(weak).alias("weak_results"),
        F.avg("hybrid_score").alias("mean_hybrid_score"), F.min("hybrid_score").alias("min_hybrid_score"))
