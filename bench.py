"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Upstream stage tables (classified landing, extraction, documents, chunks,
search index) are built first and timed as their own entries, like the
stage tables a deployment keeps; every headline query is then timed to full
completion (noop sink: all rows computed, nothing sent to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from parchment.session import get_session
    spark = get_session(f"local[{cpus}]", max(8, cpus * 2))
    from parchment.constants import EMBEDDING_MODEL, SHA_EMBEDDING_MODEL
    from parchment.plans import catalog, corpus

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    # stage tables (each written once; later stages read them)
    timed("stage_events", lambda: corpus.corpus_events(spark, sf_dir))
    timed("stage_extracted", lambda: corpus.corpus_extracted(spark, sf_dir))
    timed("stage_documents", lambda: corpus.corpus_documents(spark, sf_dir))
    timed("stage_chunks", lambda: corpus.corpus_chunks(spark, sf_dir))
    timed("stage_index_exact", lambda: corpus.corpus_index(spark, sf_dir, EMBEDDING_MODEL))
    timed("stage_index_sha", lambda: corpus.corpus_index(spark, sf_dir, SHA_EMBEDDING_MODEL))
    timed("stage_postings_sha", lambda: corpus.corpus_postings(spark, sf_dir, SHA_EMBEDDING_MODEL))
    timed("stage_questions", lambda: corpus.questions(spark, sf_dir))

    headline = ["fetch_classify", "html_text", "doc_versions", "chunk_words", "embed_hash_exact",
                "vector_topk", "keyword_topk", "hybrid_topk", "eval_summary", "ranking_metrics",
                "dup_exact", "dup_near", "stream_changes"]
    for name in headline:
        timed(name, lambda n=name: catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save())

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": timings,
                      "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
