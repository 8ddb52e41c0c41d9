"""Source registry and fetch bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.operators.joins import bounded_broadcast, narrow_side
from parchment.operators.scan import last_known_before
from parchment.session import AS_OF


def active_sources(registry: DataFrame, limit: int | None = None) -> DataFrame:
    """Active ``http_get`` sources by priority then name (``limit`` 0/None = all)."""
    out = (registry.where(F.col("is_active") & (F.col("fetch_method") == "http_get"))
           .orderBy("priority", "source_name", "source_id"))
    return out.limit(limit) if limit else out


def url_suffix(url_col) -> F.Column:
    """Suffix of the URL path's last component (``''`` if none)."""
    path = F.coalesce(F.parse_url(url_col, F.lit("PATH")), F.lit(""))
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def content_extension(source_type, source_url, content_type=None) -> F.Column:
    """Pdf, csv, api->.json, html content type->.html, else URL suffix, else .bin."""
    st = F.col(source_type) if isinstance(source_type, str) else source_type
    url = F.col(source_url) if isinstance(source_url, str) else source_url
    ct = F.lit(None).cast("string") if content_type is None else (
        F.col(content_type) if isinstance(content_type, str) else content_type)
    suffix = url_suffix(url)
    return (F.when(st == "pdf", ".pdf").when(st == "csv", ".csv").when(st == "api", ".json")
            .when(F.coalesce(F.instr(ct, "html"), F.lit(0)) > 0, ".html")
            .when(suffix != "", suffix).otherwise(".bin"))


def raw_object_path(raw_dir: str, source_id, content_hash, extension) -> F.Column:
    """S3: content-addressed key ``<raw>/<source_id>/<hash><ext>``."""
    return F.concat_ws("/", F.lit(raw_dir), F.col(source_id) if isinstance(source_id, str) else source_id,
                       F.concat(F.col(content_hash) if isinstance(content_hash, str) else content_hash,
                                extension))


def classify_fetches(fetches: DataFrame, registry: DataFrame, raw_dir: str = "data/raw") -> DataFrame:
    """Classify each fetch against the latest known hash of its source.

    ``failed`` when no hash; ``unchanged`` when equal to the previous known hash
    (failures keep the old one); else ``success`` with a raw object path.  The
    starting hash is the registry's ``current_hash``.  The per-source ordered
    scan is skew-safe (a hot source is split over many tasks).
    """
    reg = registry.select("source_id", F.col("current_hash").alias("_initial"),
                          "source_type", "source_url")
    narrow = ["event_id", "source_id", "fetched_at", "content_hash"]
    scanned = last_known_before(fetches.select(*narrow), ["source_id"], ["fetched_at", "event_id"],
                                "content_hash", "_prev")
    if set(fetches.columns) != set(narrow):  # wide rows (e.g. content) skip the scan's shuffles
        scanned = fetches.join(narrow_side(scanned.select("event_id", "_prev")), "event_id", "inner")
    joined = scanned.join(bounded_broadcast(reg), "source_id", "left")
    prev = F.coalesce(F.col("_prev"), F.col("_initial"))
    status = (F.when(F.col("content_hash").isNull(), "failed")
              .when(prev.isNotNull() & (F.col("content_hash") == prev), "unchanged")
              .otherwise("success"))
    ext = content_extension("source_type", "source_url")
    return (joined.withColumn("previous_hash", prev)
            .withColumn("status", status)
            .withColumn("object_path", F.when(F.col("status") == "success",
                                              raw_object_path(raw_dir, "source_id", "content_hash", ext)))
            .withColumn("run_id", F.sha2(F.concat(F.lit("run:"), F.to_date("fetched_at").cast("string")), 256))
            .drop("_prev", "_initial", "source_type", "source_url"))


def registry_state(registry: DataFrame, classified: DataFrame) -> DataFrame:
    """U8: registry after applying every fetch in order.

    ``current_hash = COALESCE(new hash, current_hash)`` -> last non-null hash;
    the other fetch fields come from the last fetch (a failure keeps the hash
    but loses the http status).  Two-phase aggregation: ``max_by`` is partial
    map-side, so a hot source does not pin one task.
    """
    order = F.struct("fetched_at", "event_id")
    last = classified.groupBy("source_id").agg(
        F.max_by(F.col("content_hash"), F.when(F.col("content_hash").isNotNull(), order)).alias("_hash"),
        F.max_by(F.struct("fetched_at", "status", "http_status", "error_message"), order).alias("_last"))
    j = registry.join(last, "source_id", "left")
    fetched = F.col("_last").isNotNull()
    return j.select(
        *[c for c in registry.columns if c not in (
            "current_hash", "last_fetch_at", "last_status", "last_http_status", "last_error", "updated_at")],
        F.coalesce(F.col("_hash"), F.col("current_hash")).alias("current_hash"),
        F.when(fetched, F.col("_last.fetched_at")).otherwise(F.col("last_fetch_at")).alias("last_fetch_at"),
        F.when(fetched, F.col("_last.status")).otherwise(F.col("last_status")).alias("last_status"),
        F.when(fetched, F.col("_last.http_status")).otherwise(F.col("last_http_status")).alias("last_http_status"),
        F.when(fetched, F.col("_last.error_message")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(fetched, F.col("_last.fetched_at")).otherwise(F.col("updated_at")).alias("updated_at"),
    ).select(*registry.columns)


def run_summary(classified: DataFrame) -> DataFrame:
    """One row per ingestion run with counters; ``failed`` if any fetch failed."""
    agg = classified.groupBy("run_id").agg(
        F.min("fetched_at").alias("started_at"),
        F.max("fetched_at").alias("completed_at"),
        F.count_distinct("source_id").cast("int").alias("source_count"),
        F.count_if(F.col("status").isin("success", "unchanged")).cast("int").alias("fetched_count"),
        F.count_if(F.col("status") == "success").cast("int").alias("changed_count"),
        F.count_if(F.col("status") == "failed").cast("int").alias("failed_count"))
    return agg.withColumn("status", F.when(F.col("failed_count") == 0, "success").otherwise("failed"))


def sources_due(registry_now: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Active sources whose refresh policy says a fetch is due at ``as_of``.

    Never fetched -> due; ``manual`` -> never due by policy.
    """
    t = F.col("last_fetch_at")
    nxt = (F.when(F.col("refresh_policy") == "daily", t + F.expr("INTERVAL 1 DAY"))
           .when(F.col("refresh_policy") == "weekly", t + F.expr("INTERVAL 7 DAYS"))
           .when(F.col("refresh_policy") == "monthly", t + F.expr("INTERVAL 1 MONTH")))
    due = F.col("is_active") & (F.col("refresh_policy") != "manual") & (
        t.isNull() | (nxt <= F.lit(as_of).cast("timestamp")))
    return registry_now.withColumn("next_fetch_at", nxt).where(due)
