"""What keeps the corpus stages small: texts are moved once, never sorted, and read once."""

import numpy as np
import pandas as pd

from parchment.functions import embedding
from parchment.operators import chunking, extract, governance, ingest
from parchment.operators import embedding as search

def _plan(df):
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_never_sorted(spark):
    reg = spark.createDataFrame([("s", "html", "https://a/b", "name")], "source_id string, source_type string, source_url string, source_name string") \
        .selectExpr("*", "cast(null as string) current_hash")
    landed = spark.createDataFrame([(1, "s", "h1", "<p>a</p>"), (2, "s", "h1", "b")], "event_id long, source_id string, content_hash string, content string") \
        .selectExpr("*", "timestamp '2024-01-01' + make_dt_interval(0, 0, 0, event_id) fetched_at")
    events = ingest.classify_fetches(landed, reg)
    plan = _plan(events.select("event_id", "status", "content"))
    assert plan.count("ShuffledHashJoin") >= 1 and "SortMergeJoin event_id" not in plan and "SortMergeJoin [event_id" not in plan
    pending = extract.pending_extraction(events.selectExpr("*"), reg, spark.createDataFrame([], "event_id long"))
    texts = extract.extract_events(pending)
    assert [r.extracted_text for r in texts.collect()] == ["a"]
    docs = spark.createDataFrame([("d", "e", "ai_ready")], "document_id string, extracted_text_id string, document_status string")
    held = spark.createDataFrame([("e", "one two")], "extracted_text_id string, extracted_text string")
    assert "SortMergeJoin" not in _plan(chunking.pending_chunks(docs, held))
    merged = governance.upsert_latest(spark.createDataFrame([(1, "a", 1)], "k long, t string, v long"),
                                      spark.createDataFrame([(1, "b", 2)], "k long, t string, v long"), ["k"], ["v"])
    assert "SortMergeJoin" not in _plan(merged) and [r.t for r in merged.collect()] == ["b"]


def test_vectors_are_made_after_the_join(spark):
    chunks = spark.createDataFrame([("c", "d", "s", 1, 2, "one two")], "chunk_id string, document_id string, source_id string, chunk_index int, word_count int, chunk_text string")
    docs = spark.createDataFrame([("d",) * 8], "document_id string, title string, agency string, topic string, document_type string, source_url string, version_number string, document_status string")
    plan = _plan(search.search_index(chunks, docs))
    assert plan.index("ArrowEvalPython") < plan.index("ShuffledHashJoin")


def test_texts_are_read_once(spark):
    text = "\x1c a b\xa0c " + " ".join(f"w{i}" for i in range(997)) + "\n"
    df = spark.createDataFrame([(1, text), (2, " \t"), (3, None), (4, "w " * 7)], "id long, t string")
    cut = chunking.chunk_text(df, "t", 10, 3, keep=("id",))
    words = {i: (t or "").split() for i, t in ((r.id, r.t) for r in df.collect())}
    want = {(i, k + 1): (" ".join(w[at:at + 10]), len(w[at:at + 10])) for i, w in words.items() if w
            for k, at in enumerate(range(0, max(1, len(w) - 3), 7))}
    assert {(r.id, r.chunk_index): (r.chunk_text, r.word_count) for r in cut.collect()} == want
    plan = _plan(extract.route_extraction(df.selectExpr("'html' source_type", "t raw_text")))
    assert "regexp_extract_all" not in plan and plan.count("split(") == 0 and plan.count("ArrowEvalPython") == 1


def test_features_are_numbered():
    texts = pd.Series(["Alpha beta the beta-2 alpha", "", None, "the of", "beta-2 alpha beta"])
    for model, digests in embedding.DIGESTS.items():
        assert digests(["x", "é_y"]).tolist() == [embedding.HASHERS[model](f) for f in ("x", "é_y")]
        got = embedding.embed_batch(texts, model, 16)
        for row, tokens in zip(got, (["alpha", "beta", "beta-2", "alpha"], [], [], [], ["beta-2", "alpha", "beta"])):
            want = np.zeros(16)
            for f, w in [(t, 1.0) for t in tokens] + [(f"{a}_{b}", 1.5) for a, b in zip(tokens, tokens[1:])]:
                v = embedding.HASHERS[model](f)
                want[v % 16] += -w if v & 1 else w
            assert np.allclose(row, want / (np.linalg.norm(want) or 1), atol=1e-8)


def test_only_runs_of_blanks_that_change_are_replaced():
    texts = ["a b  c", "\ta\t b \t", " one two\n\n x\ty ", None, ""]
    got = extract.clean_text.func(pd.Series(texts), pd.Series([False] * 5))
    assert list(got["extracted_text"][:3]) == ["a b c", "a b", "one two\nx y"] and list(got["word_count"]) == [3, 2, 4, 0, 0]
    assert not extract._BLANKS.search("words with one blank between them")  # each of these was replaced by itself


def test_stage_tables_are_written_small(spark):
    import glob

    from parchment.session import checkpoint_root, materialize
    name = "written-small"
    assert materialize(spark.range(10), name).count() == 10
    assert glob.glob(f"{checkpoint_root(spark)}/{name}-*/*.zstd.parquet")


def test_texts_stay_where_they_are_while_passages_are_looked_for(spark):
    from parchment.sources import fixtures
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "x y z")], "item_id long, passage string")
    docs = spark.createDataFrame([(7, "zero one two three four five six"), (8, "w x y z"), (9, None)], "doc_id long, text string")
    found = fixtures.contained_passages(bench, docs)
    plan = _plan(found)
    assert "BroadcastHashJoin [doc_id" in plan and "hashpartitioning(doc_id" not in plan
    assert sorted(map(tuple, found.collect())) == [(1, 7), (2, 8)]


def test_versions_are_written_small(spark, tmp_path):
    from parchment.sources.snapshots import VersionedTable
    table = VersionedTable(spark, f"{tmp_path}/t", ["id"])
    table.overwrite(spark.range(10))
    assert table.read().count() == 10 and list(tmp_path.glob("t/data-*/*/*.zstd.parquet"))
