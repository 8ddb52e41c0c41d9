"""Versioned tables, merges by narrow winners, seeds with defaults, and the change stream."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException

from parchment.operators import extract
from parchment.operators import governance as gov
from parchment.sources import fixtures
from parchment.sources.fixtures import registry_from_ids
from parchment.sources.snapshots import VersionConflict, VersionedTable
from parchment.streaming import changes
from test_skew import _fetches, _loop

ROWS = "k string, t int, body string"


def _table(spark, tmp_path, **more):
    return VersionedTable(spark, f"{tmp_path}/{uuid.uuid4().hex}", ["k"], **more)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_newer_older_tied_null_and_repeated_keys(spark, tmp_path):
    old = [("a", 1, "a1"), ("b", 5, "b5"), ("c", 2, "c2"), (None, 1, "n1"), ("z", None, "z0")]
    new = [("b", 4, "older"), ("c", 2, "tie"), ("d", 1, "d1"), ("d", 3, "d3"), (None, 2, "n2"), ("z", None, "z1"), ("e", 1, None)]
    want = sorted([("a", 1, "a1"), ("b", 5, "b5"), ("c", 2, "tie"), ("d", 3, "d3"), (None, 2, "n2"), ("z", None, "z1"),
                   ("e", 1, None)], key=repr)
    table = _table(spark, tmp_path)
    table.overwrite(spark.createDataFrame(old, ROWS))
    incoming = spark.createDataFrame(new, ROWS)
    assert table.upsert(incoming, ["t"]) == 2
    assert _got(table.read()) == want
    table.upsert(incoming, ["t"])  # again: nothing changes
    assert _got(table.read()) == want
    assert _got(table.read(1)) == sorted(old, key=repr)  # versions before stay readable
    assert _got(gov.upsert_latest(spark.createDataFrame(old, ROWS), incoming, ["k"], ["t"])) == want


def test_upsert_carries_untouched_buckets_over(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=8)
    table.overwrite(spark.createDataFrame([(f"k{i}", 0, "x") for i in range(200)], ROWS))
    before = table.latest()
    table.upsert(spark.createDataFrame([("k7", 1, "y")], ROWS), ["t"])
    after = table.latest()
    assert len(before.parts) == 8 and len(set(before.parts) & set(after.parts)) == 7 and len(after.parts) == 8
    assert table.read().count() == 200 and table.read().where("body = 'y'").count() == 1


def test_append_keeps_stored_rows_and_adds_each_new_key_once(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.append(spark.createDataFrame([("a", 1, "a")], ROWS))
    first = table.latest()
    table.append(spark.createDataFrame([("a", 9, "changed"), ("b", 1, "b"), ("b", 1, "b"), (None, 1, "n")], ROWS))
    table.append(spark.createDataFrame([(None, 2, "again")], ROWS))
    assert _got(table.read()) == sorted([("a", 1, "a"), ("b", 1, "b"), (None, 1, "n")], key=repr)
    assert set(first.parts) <= set(table.latest().parts)


def test_empty_tables_and_a_lost_race(spark, tmp_path):
    table, none = _table(spark, tmp_path), spark.createDataFrame([], ROWS)
    assert table.latest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.overwrite(none)
    table.upsert(none, ["t"])
    assert table.append(none) == 3 and table.read().schema.names == ["k", "t", "body"] and table.read().count() == 0
    with pytest.raises(VersionConflict):
        table._commit(table.version(2), none.schema, [])


def test_no_aggregate_buffer_holds_the_payload(spark):
    old, new = spark.createDataFrame([("a", 1, "x")], ROWS), spark.createDataFrame([("a", 2, "y")], ROWS)
    plan = gov.upsert_latest(old, new, ["k"], ["t"])._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("body" in line for line in aggregates)


def test_seeded_rows_get_a_key_and_defaults(spark):
    reg = registry_from_ids(spark.createDataFrame([("src1",), ("src2",)], "source_id string"))
    seed = spark.createDataFrame([("https://new.example.gov/", "New", 5), ("https://agency1.example.gov/src1/index.html", "Old", 6)],
                                 "source_url string, source_name string, priority int")
    rows = {r["source_name"]: r for r in gov.seed_merge(reg, seed, "source_url", ["source_name", "priority"],
                                                        inserted=gov.registry_defaults()).collect()}
    new, old = rows["New"], rows["Old"]
    assert len(rows) == 3 and len(new["source_id"]) == 64 and new["is_active"] and new["priority"] == 5
    assert (new["last_status"], new["fetch_method"], new["refresh_policy"]) == ("not_started", "http_get", "weekly")
    assert old["source_id"] == "src1" and old["priority"] == 6 and old["refresh_policy"] == "weekly"


def test_stream_with_a_hot_source_and_a_failed_batch_counts_every_row_once(spark, tmp_path, monkeypatch):
    rows = _fetches(600)
    fetches = spark.createDataFrame(rows, changes.FETCH_SCHEMA)
    work, middle = f"{tmp_path}/w", sorted(r[2] for r in rows)[300]
    early, late = fetches.where(fetches.fetched_at < middle), fetches.where(fetches.fetched_at >= middle)
    early.write.mode("append").parquet(f"{work}/landing")
    changes.take_landed(spark, f"{work}/landing", work)
    late.write.mode("append").parquet(f"{work}/landing")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:  # the sink is written, the state is not
        broken.setattr(VersionedTable, "upsert", fail)
        with pytest.raises(StreamingQueryException):
            changes.take_landed(spark, f"{work}/landing", work)
    assert changes.detected(spark, work).count() == early.count()
    changes.take_landed(spark, f"{work}/landing", work)
    got = changes.detected(spark, work).collect()
    assert len(got) == 600 and {r["event_id"]: r["status"] for r in got} == _loop(rows)
    latest = changes.known_hashes(spark, work).latest().number
    changes.classify_batch(spark, late, 1, work)  # a batch that was finished already
    assert changes.known_hashes(spark, work).latest().number == latest
    assert changes.detected(spark, work).count() == 600


def test_stream_of_an_empty_log(spark, tmp_path):
    out = changes.run_change_detection(spark, spark.createDataFrame([], changes.FETCH_SCHEMA), f"{tmp_path}/e")
    assert out.count() == 0 and out.columns == list(changes.COLUMNS)

def test_contained_passages_cut_words_empty_null_and_short_blocks(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_SHORT_BLOCK", 2)
    texts = [(1, "zab cde f"), (2, "ab cd"), (3, None), (4, ""), (5, "one two three four five six"), (6, "xone two threey")]
    asked = [(1, "ab cd"), (2, ""), (3, None), (4, " "), (5, "e"), (6, "one two three"), (7, "ne two three four fi"), (8, "f"),
             (9, "absent"), (10, "six")]
    bench = spark.createDataFrame(asked, "item_id long, passage string")
    got = fixtures.contained_passages(bench, spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = sorted((i, d) for i, p in asked for d, t in texts if p and p.strip() and t and p in t)
    assert sorted(map(tuple, got)) == want and (1, 1) in want


def test_html_references_and_unclosed_blocks(spark):
    pages = [("a&mdash;b&#8217;s&#x27;&eacute;", "a—b’s'é"), ("x &amp;lt; y &lt;b&gt; &unknown; & &&", "x &lt; y <b> &unknown; & &&"),
             ("kept<script>var a = '<p>'", "kept"), ("kept<!-- never closed <p>gone</p>", "kept"), (None, None), ("", ""),
             ("<STYLE>p{}</STYLE >a<p>b&nbsp;c</p>", "a\nb c"), ("a < b and c > d", "a < b and c > d")]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "i int, page string")
    got = [r["t"] for r in df.select("i", extract.html_to_text("page").alias("t")).orderBy("i").collect()]
    assert [g and " ".join(g.split(" ")).replace("\xa0", " ") for g in got] == [w for _, w in pages]
