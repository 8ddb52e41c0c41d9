"""Edge cases of the blueprint's fixture list, on small hand-made frames."""

import hashlib
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parchment.constants import EMBEDDING_MODEL, SHA_EMBEDDING_MODEL
from parchment.functions.embedding import embed
from parchment.operators import chunking, documents, evaluation, extract, governance, ingest, keyword, retrieval
from parchment.sources.fixtures import registry_from_ids

T0 = datetime(2024, 1, 1)


def _registry(spark, ids=("src1",)):
    return registry_from_ids(spark.createDataFrame([(i,) for i in ids], "source_id string"))


def test_change_detection_sequence(spark):
    hashes = ["A", "A", "B", None, "B", "A"]
    rows = [(i, "src1", T0 + timedelta(minutes=i), h) for i, h in enumerate(hashes)]
    f = spark.createDataFrame(rows, "event_id long, source_id string, fetched_at timestamp, content_hash string")
    out = ingest.classify_fetches(f, _registry(spark)).orderBy("event_id").select("status").collect()
    assert [r[0] for r in out] == ["success", "unchanged", "success", "failed", "unchanged", "success"]


def test_registry_state_keeps_hash_after_failure(spark):
    rows = [(0, "src1", T0, "A", 200, None), (1, "src1", T0 + timedelta(hours=1), None, None, "boom")]
    f = spark.createDataFrame(rows, "event_id long, source_id string, fetched_at timestamp, content_hash string, "
                                    "http_status int, error_message string")
    reg = _registry(spark)
    st = ingest.registry_state(reg, ingest.classify_fetches(f, reg)).collect()[0]
    assert st["current_hash"] == "A" and st["last_status"] == "failed" and st["last_http_status"] is None


def _records(spark, rows):
    return spark.createDataFrame(rows, "extracted_text_id string, source_id string, event_id long, "
                                       "extraction_status string, character_count int, word_count int, "
                                       "extracted_at timestamp, source_name string, source_url string, "
                                       "source_type string, agency string, domain string, topic string, "
                                       "content_hash string")


def test_versions_a_b_a(spark):
    base = ("src1", "success", 2000, 300)
    rows = [(f"x{i}", base[0], i, base[1], base[2], base[3], T0 + timedelta(minutes=i), "Title", "http://u/x.html",
             "html", "Agency", "d", "t", h) for i, h in enumerate(["A", "B", "A"])]
    docs = documents.build_documents(_records(spark, rows)).orderBy("version_number").collect()
    assert [(d["content_hash"], d["version_number"]) for d in docs] == [("A", 1), ("B", 2)]
    # last extraction of A wins for the fields, version stays 1
    assert docs[0]["extracted_text_id"] == "x2"


@pytest.mark.parametrize("chars,words,status", [(1000, 150, "ai_ready"), (999, 150, "quarantined"),
                                                (1000, 149, "quarantined")])
def test_quality_thresholds(spark, chars, words, status):
    rows = [("x", "src1", 1, "success", chars, words, T0, "T", "http://u", "html", "A", "d", "t", "h")]
    r = documents.readiness(_records(spark, rows)).collect()[0]
    assert r["document_status"] == status


def test_blank_title_and_agency_fail_two_rules(spark):
    rows = [("x", "src1", 1, "success", 5000, 900, T0, "  ", "http://u", "html", "", "d", "t", "h")]
    r = documents.readiness(_records(spark, rows)).collect()[0]
    assert r["failed_rules"] == "title_present,agency_present"


@pytest.mark.parametrize("n_chars,status", [(499, "quarantined"), (500, "success")])
def test_extraction_threshold(spark, n_chars, status):
    df = spark.createDataFrame([("pdf", "x" * n_chars)], "source_type string, raw_text string")
    assert extract.route_extraction(df).collect()[0]["extraction_status"] == status


def test_extraction_unsupported(spark):
    df = spark.createDataFrame([("csv", "a,b")], "source_type string, raw_text string")
    r = extract.route_extraction(df).collect()[0]
    assert (r["extraction_status"], r["extraction_method"], r["character_count"]) == ("failed", "unsupported", 0)


def test_html_text_drops_scripts_and_decodes(spark):
    html = ('<html><head><title>T &amp; U</title><script>var t="</p>";</script><style>p{}</style></head>'
            '<body><p>one  two</p><!-- c --><noscript>x</noscript><p>&copy; 3</p></body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(extract.html_to_text("html")).collect()[0][0] == "T & U\none two\n© 3"


@pytest.mark.parametrize("n,k", [(0, 0), (1, 1), (40, 1), (220, 1), (221, 2), (400, 2), (401, 3)])
def test_chunk_counts(spark, n, k):
    text = " ".join(f"w{i}" for i in range(n))
    df = spark.createDataFrame([("d", text)], "doc string, extracted_text string")
    out = chunking.chunk_text(df, keep=("doc",)).orderBy("chunk_index").collect()
    assert len(out) == k
    if k:
        words = text.split()
        rebuilt = words[:220]
        for c in out[1:]:
            w = c["chunk_text"].split()
            assert w[:40] == rebuilt[-40:]
            rebuilt += w[40:]
        assert rebuilt == words
        assert out[0]["chunk_hash"] == hashlib.sha256(out[0]["chunk_text"].encode()).hexdigest()


@pytest.mark.parametrize("c,o", [(0, 0), (220, -1), (220, 220)])
def test_chunk_argument_errors(c, o):
    with pytest.raises(ValueError):
        chunking.check_chunk_args(c, o)


def test_embedding_slots_signs_and_invariants(spark):
    texts = ["", "the of and", None, "risk", "risk management", "Risk-based AI governance, for the agency's plan 2024."]
    got = [[float(x) for x in r["e"]] for r in spark.createDataFrame(
        [(t,) for t in texts], "t string").select(embed("t").alias("e")).collect()]
    for row in got:
        assert all(x <= 0 for x in row[1::2]) and all(x >= 0 for x in row[0::2])
        n = math.sqrt(sum(x * x for x in row))
        assert n == pytest.approx(1.0, abs=1e-5) or n == 0.0
    assert [sum(x != 0 for x in row) for row in got[:5]] == [0, 0, 0, 1, 3]
    for name, weight in (("risk", 1.0), ("management", 1.0), ("risk_management", 1.5)):
        value = int(hashlib.blake2b(name.encode(), digest_size=8).hexdigest(), 16)
        assert got[4][value % 128] == pytest.approx((-1) ** (value % 2) * weight / math.sqrt(4.25), abs=1e-7)


def test_split_label_check_raises(spark):
    examples = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (3, 1)], "question_id int, label int")
    splits = spark.createDataFrame([(1, "train"), (2, "validation"), (3, "test")], "question_id int, split string")
    with pytest.raises(Exception, match="one label is missing in split validation"):
        evaluation.split_label_check(examples, splits, raise_on_fail=True).collect()


def test_seed_merge_overwrites_with_null_and_reactivates(spark):
    now = spark.createDataFrame([("q", "old", False), ("r", "kept", False)], "k string, title string, is_active boolean")
    seed = spark.createDataFrame([("q", None)], "k string, title string")
    got = governance.seed_merge(now, seed, "k", ["title"], "is_active").collect()
    assert {(r.k, r.title, r.is_active) for r in got} == {("q", None, True), ("r", "kept", False)}


def _index(spark, texts):
    rows = [(f"c{i}", f"d{i}", "s", 1, 10, t, "Title", "Agency (1)", "topic", "html", "http://u", 1)
            for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "chunk_id string, document_id string, source_id string, chunk_index int, "
                                     "word_count int, chunk_text string, title string, agency string, topic string, "
                                     "document_type string, source_url string, version_number int")
    return (df.withColumn("embedding", embed("chunk_text", SHA_EMBEDDING_MODEL))
            .withColumn("preview", F.substring("chunk_text", 1, 520)))


def test_cover_density_scores(spark):
    idx = _index(spark, ["risk plan here", "risk x y plan", "only risk here"])
    q = spark.createDataFrame([(1, "risk plan")], "query_id long, query_text string")
    got = {r["chunk_id"]: r["keyword_score"] for r in keyword.keyword_pairs(idx, q).collect()}
    assert got == {"c0": pytest.approx(0.1), "c1": pytest.approx(0.1 / 3)}


def test_hybrid_cap_modes_and_filters(spark):
    idx = _index(spark, ["risk plan " * 5, "other words entirely", "risk"])
    q = spark.createDataFrame([(1, "risk plan")], "query_id long, query_text string")
    kw = retrieval.retrieve(idx, q, "keyword", 5, SHA_EMBEDDING_MODEL).collect()
    assert [r["chunk_id"] for r in kw] == ["c0"]
    r = kw[0]
    assert r["hybrid_score"] == pytest.approx(0.65 * r["vector_similarity"] + 0.35)   # keyword part capped
    none = spark.createDataFrame([(1, "zzz")], "query_id long, query_text string")
    assert retrieval.retrieve(idx, none, "keyword", 5, SHA_EMBEDDING_MODEL).count() == 0
    blank = spark.createDataFrame([(1, "risk", "  ")], "query_id long, query_text string, agency string")
    assert retrieval.retrieve(idx, blank, "hybrid", 5, SHA_EMBEDDING_MODEL).count() == 3
    wild = spark.createDataFrame([(1, "risk", "agency _1_")], "query_id long, query_text string, agency string")
    assert retrieval.retrieve(idx, wild, "hybrid", 5, SHA_EMBEDDING_MODEL).count() == 3
    miss = spark.createDataFrame([(1, "risk", "bureau")], "query_id long, query_text string, agency string")
    assert retrieval.retrieve(idx, miss, "vector", 5, SHA_EMBEDDING_MODEL).count() == 0


def test_evaluation_mrr_and_empty(spark):
    rows = [(1, True, 1), (2, True, 2), (3, False, None), (4, True, 5)]
    o = spark.createDataFrame(rows, "question_id long, matched boolean, first_relevant_rank int")
    s = evaluation.evaluation_summary(o).collect()[0]
    assert (s["hit_count"], s["mean_reciprocal_rank"]) == (3, pytest.approx(0.425))
    e = evaluation.evaluation_summary(o.limit(0)).collect()[0]
    assert e["mean_reciprocal_rank"] == 0.0 and e["hit_rate"] == 0.0


def test_precision_divides_by_returned_rows(spark):
    rows = [(1, 1, 1, 0.9), (1, 2, 0, 0.5), (1, 3, 0, 0.1)]
    df = spark.createDataFrame(rows, "question_id long, candidate_rank int, label int, hybrid_score double")
    m = evaluation.grouped_metrics(df, "hybrid_score", 5).collect()[0]
    assert m["precision_at_5"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("n,sizes", [(16, (8, 4, 4)), (10, (6, 2, 2))])
def test_grouped_split_sizes(spark, n, sizes):
    qs = spark.createDataFrame([(i, f"question {i}") for i in range(n)], "question_id long, question_text string")
    got = {r["split"]: r["c"] for r in evaluation.grouped_split(qs).groupBy("split").agg(F.count("*").alias("c")).collect()}
    assert (got["train"], got["validation"], got["test"]) == sizes


def test_grouped_split_too_small(spark):
    qs = spark.createDataFrame([(0, "a"), (1, "b")], "question_id long, question_text string")
    with pytest.raises(ValueError):
        evaluation.grouped_split(qs)


def test_blend_sweep_ties_pick_lowest_weight(spark):
    rows = [(1, 1, 1, 0.5, 0.5), (1, 2, 0, 0.2, 0.2)]
    df = spark.createDataFrame(rows, "question_id long, candidate_rank int, label int, probability double, "
                                     "hybrid_score double")
    best = evaluation.select_weight(evaluation.blend_sweep(df)).collect()[0]
    assert best["weight"] == 0.0


def test_average_precision_step_sum(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.7), (1, 0.1)]
    df = spark.createDataFrame(rows, "label int, probability double")
    ap = evaluation.average_precision(df).collect()[0][0]
    # thresholds: 0.9 -> P=1,R=1/3; 0.8 -> P=.5; 0.7 -> P=2/4,R=2/3; 0.1 -> P=3/5,R=1
    assert ap == pytest.approx(1 / 3 * 1 + 1 / 3 * 0.5 + 1 / 3 * 0.6)


def test_coverage_counts_twice_with_two_models(spark):
    ch = spark.createDataFrame([("c1", "d1")], "chunk_id string, document_id string")
    emb = spark.createDataFrame([("c1", "e1"), ("c1", "e2")], "chunk_id string, embedding_id string")
    r = governance.report_coverage(ch, emb).collect()[0]
    assert (r["chunked_documents"], r["chunks"], r["embeddings"]) == (1, 2, 2)


def test_upsert_latest_wins_and_rerun_adds_nothing(spark):
    old = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], "k long, v string, t timestamp")
    new = spark.createDataFrame([(1, "c", T0 + timedelta(days=1))], "k long, v string, t timestamp")
    m = governance.upsert_latest(old, new, ["k"], ["t"])
    assert sorted((r["k"], r["v"]) for r in m.collect()) == [(1, "c"), (2, "b")]
    again = governance.upsert_latest(m, new, ["k"], ["t"])
    assert again.count() == 2


def test_pending_sets_are_empty_on_rerun(spark):
    docs = spark.createDataFrame([("d1", "ai_ready", "x1")], "document_id string, document_status string, "
                                                              "extracted_text_id string")
    ex = spark.createDataFrame([("x1", "one two three")], "extracted_text_id string, extracted_text string")
    pend = chunking.pending_chunks(docs, ex)
    chunks = chunking.build_chunks(pend.withColumn("source_id", F.lit("s")).withColumn("updated_at", F.lit(T0)))
    assert chunking.pending_chunks(docs, ex, chunks).count() == 0


def test_exact_blake2b_model_is_default():
    assert EMBEDDING_MODEL == "local_hashing_v1"


def test_binary_landing_hash_and_decode(spark, tmp_path):
    from parchment.sources.raw import read_raw_objects, work_order
    (tmp_path / "a.html").write_bytes("<p>café</p>".encode() + b"\xff")
    rows = read_raw_objects(spark, str(tmp_path), "*.html").collect()
    assert len(rows) == 1
    assert rows[0]["content_hash"] == hashlib.sha256("<p>café</p>".encode() + b"\xff").hexdigest()
    assert rows[0]["raw_text"] == "<p>café</p>"
    df = spark.createDataFrame([(3,), (1,), (2,)], "x int")
    assert [r[0] for r in work_order(df, ["x"], 2).collect()] == [1, 2]
    assert work_order(df, ["x"], 0).count() == 3


def test_single_query_api(spark):
    from parchment.api import retrieve_text, search_text
    idx = _index(spark, ["risk plan " * 5, "other words entirely", "risk"])
    rows = retrieve_text(spark, idx, "risk plan", "hybrid", 2, model=SHA_EMBEDDING_MODEL).collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0]["chunk_id"] == "c0"
    assert search_text(spark, idx, "risk", 1, SHA_EMBEDDING_MODEL).count() == 1
