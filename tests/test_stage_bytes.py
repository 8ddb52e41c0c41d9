"""Stage tables hold and moves carry a text once; what follows from other columns is neither written nor moved."""

import contextlib
import glob
import io
import re

from pyspark.sql import functions as F

from parchment.functions.text import words
from parchment.operators import keyword
from parchment.plans import corpus
from parchment.session import checkpoint_root
from parchment.sources import fixtures


def _formatted(df) -> str:
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain("formatted")
    return said.getvalue()


def _moved(df) -> list[tuple[list[str], str]]:
    """Columns and distribution of each exchange."""
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: (.*)", _formatted(df))
    return [([c.split("#")[0] for c in columns.split(", ")], how) for columns, how in found]


def _landed(spark, path, rows) -> str:
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_events_hold_no_second_copy_of_the_objects(spark, tmp_path):
    sf = _landed(spark, tmp_path, [(i, f"src{i % 3}", f"text {i}") for i in range(20)] + [(20, "src1", None)])
    events = corpus.corpus_events(spark, sf)
    assert "content" not in events.columns and events.count() == 21
    whole = corpus.with_content(spark, sf, events)
    assert "SortMergeJoin" not in _formatted(whole)  # texts are not sorted
    assert {r.event_id: r.content for r in whole.collect()} == {**{i: f"text {i}" for i in range(20)}, 20: None}


def test_rows_of_one_event_keep_their_own_content(spark, tmp_path):
    sf = _landed(spark, tmp_path, [(1, "src1", "one"), (1, "src1", "other"), (2, "src1", "two"), (3, "src1", None), (3, "src1", None), (None, "src1", "lost")])
    events = corpus.corpus_events(spark, sf)
    whole = corpus.with_content(spark, sf, events)
    assert whole.count() == events.count() and set(whole.columns) == {*events.columns, "content"}
    assert whole.where(~F.sha2("content", 256).eqNullSafe(F.col("content_hash"))).count() == 0


def test_index_holds_no_second_copy_of_its_texts(spark, tmp_path):
    sf = _landed(spark, tmp_path, [(i, f"src{i}", f"{i} some more words " * 60) for i in range(12)])
    index = corpus.corpus_index(spark, sf)
    assert index.count() > 0 and index.where("preview <> substring(chunk_text, 1, length(preview)) OR preview IS NULL OR preview = ''").count() == 0
    newest = max(glob.glob(f"{checkpoint_root(spark)}/index-*"), key=lambda p: glob.os.stat(p).st_mtime)
    stored = spark.read.parquet(newest)
    assert "preview" not in stored.columns and stored.count() == index.count()


def test_runs_are_counted_once_and_what_follows_is_not_moved(spark, monkeypatch):
    made, whole = {}, keyword.materialize
    monkeypatch.setattr(keyword, "materialize", lambda df, name, *a, **k: made.setdefault(name, df) and whole(df, name, *a, **k))
    index = spark.range(300).selectExpr("concat('c', id) chunk_id", "'common ' || id chunk_text", "id chunk_no")
    stored = keyword.build_postings(index)
    assert stored.where("term = 'common'").select("df", "n_blocks", "width").distinct().collect() == [(300, 4, 9)]
    assert stored.where("term = '7'").select("df", "n_blocks", "width", "block").collect() == [(1, 1, 37, 0)]
    assert made["posting-terms"].columns == ["term", "df"]
    moved = [columns for columns, how in _moved(made["postings"]) if "REPARTITION" in how]
    assert moved and all(not {"n_blocks", "width", "folder"} & set(columns) for columns in moved)
    assert "Aggregate" not in _formatted(made["postings"])


def test_pairs_are_moved_narrow(spark):
    """Of a found word its number and places are moved; named pairs are not moved again to be made distinct."""
    index = spark.createDataFrame([("a", "x y z", 0), ("a", "w v", 0), ("b", "y x", 1), ("c", "x", 2)], "chunk_id string, chunk_text string, chunk_no long")
    asked = spark.createDataFrame([(1, '"x y"'), (2, "x -z"), (3, "y or z")], "query_id long, query_text string")
    pairs = keyword.keyword_pairs(index, asked, syntax="web")
    moved = _moved(pairs)
    found = [columns for columns, how in moved if "query_id" in how and "clause" in how and "positions" in columns]
    assert found and all(set(c) == {"query_id", "clause", "chunk_id", "ask", "positions"} for c in found)
    assert sum("hashpartitioning(query_id" in how and "chunk_id" in how and "clause" not in how for _, how in moved) == 1  # the scores' sums
    assert sorted((r.query_id, r.chunk_id) for r in pairs.collect()) == [(1, "a"), (2, "b"), (2, "c"), (3, "a"), (3, "b")]


def test_words_take_one_pass(spark):
    texts = [None, "", " ", "a", " a\t b\n\x1c c ", "a  b", "\n", "\x85a b "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words("t").alias("w"))
    assert [r.w for r in rows.collect()] == [None if t is None else t.split() for t in texts]
    assert "regexp_replace" not in _formatted(rows)


def test_trigrams_are_hashed_in_place(spark):
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "x y z"), (3, "so few"), (4, "no such words in here")], "item_id long, passage string")
    docs = spark.createDataFrame([(7, "zero one two three four five six"), (8, "w x y z"), (9, "so few"), (10, "a"), (11, None)], "doc_id long, text string")
    found = fixtures.contained_passages(bench, docs)
    assert sorted(map(tuple, found.collect())) == [(1, 7), (2, 8), (3, 9)]
    assert "UDF" not in _formatted(found)
    w = spark.createDataFrame([(["a", "b", "c", "d"],)], "w array<string>")
    assert w.select(fixtures._hash_of_three("w", F.lit(1)) == F.xxhash64(*[F.lit(x) for x in "bcd"])).first()[0]
