"""Matching by parts of the chunks, taken where candidates are many, against the broadcast way and a direct reading."""

import numpy as np
import pytest

from parchment.operators import keyword
from test_keyword_index import CHUNKS, QUERIES, _score


@pytest.fixture(scope="module")
def named(spark):
    return spark.createDataFrame([*CHUNKS, (None, "common rate without a name")], "chunk_id string, chunk_text string").repartition(3)


@pytest.fixture(scope="module")
def numbered(spark):
    rows = [(c, text, 7 + 5 * n) for n, (c, text) in enumerate(CHUNKS)] + [("h3", CHUNKS[10][1], None)]
    return spark.createDataFrame(rows, "chunk_id string, chunk_text string, chunk_no long").repartition(3)


def _in_parts(monkeypatch, postings_a_part):
    """Every match takes the way by parts; what that way is given."""
    taken, whole = [], keyword._match_parts
    monkeypatch.setattr(keyword, "MAX_WANTED", -1)
    monkeypatch.setattr(keyword, "PART_POSTINGS", postings_a_part)
    monkeypatch.setattr(keyword, "_NEIGHBOURS", 4)
    monkeypatch.setattr(keyword, "_match_parts", lambda *a: taken.append(a[3]) or whole(*a))
    return taken


@pytest.mark.parametrize("kind", ["named", "numbered"])
@pytest.mark.parametrize("postings_a_part", [100, 1 << 18])
def test_query_forms_by_parts(spark, monkeypatch, request, kind, postings_a_part):
    index = request.getfixturevalue(kind)
    asked = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, query_text string")
    taken = _in_parts(monkeypatch, postings_a_part)
    got = [tuple(r) for r in keyword.keyword_pairs(index, asked, syntax="web").collect()]
    want = {(q, c): s for q, text in enumerate(QUERIES) for c, chunk in CHUNKS if (s := _score(text, chunk))}
    assert len(taken) == 1 and taken[0] > 1400
    assert len(got) == len(want) and {x[:2] for x in got} == want.keys()
    assert all(abs(want[q, c] - s) < 1e-9 for q, c, s in got)


def test_both_ways_give_the_same(spark, monkeypatch, numbered):
    """Also for queries that come twice or have no id, which match as they did."""
    asked = spark.createDataFrame([("a", "rate or common"), ("a", "rate or common"), ("b", 'rate -"base unheard"'), (None, "rate"),
                                   ("c", 'base rate or "base rate" or bank'), ("d", "rate -common"), ("d", "bank rate")],
                                  "query_id string, query_text string")
    stored = keyword.build_postings(numbered)
    want = {tuple(r)[:2]: r.keyword_score for r in keyword.keyword_pairs(numbered, asked, stored, syntax="web").collect()}
    taken = _in_parts(monkeypatch, 50)
    got = keyword.keyword_pairs(numbered, asked, stored, syntax="web")
    assert got.dtypes == [("query_id", "string"), ("chunk_id", "string"), ("keyword_score", "double")]
    got = {tuple(r)[:2]: r.keyword_score for r in got.collect()}
    assert taken and len(want) > 5 and {k: round(s, 9) for k, s in got.items()} == {k: round(s, 9) for k, s in want.items()}


@pytest.mark.parametrize("number", ["", ", chunk_no long"])
def test_rows_of_one_chunk_count_as_they_did(spark, monkeypatch, number):
    """Positions that two rows of a chunk share count twice, as they do where candidates are few."""
    chunks = [("a", "x y z", 0), ("a", "x y z", 0), ("b", "x y", 1), ("c", "x q", 2), ("c", "w y z", 2), ("d", "y x", 3)]
    index = spark.createDataFrame([c[:3 if number else 2] for c in chunks], "chunk_id string, chunk_text string" + number)
    asked = spark.createDataFrame(list(enumerate(["x", '"x y"', "x y", '"x unheard"', 'y -"x unheard"', "x -z", "y -x", '"y z" or q'])),
                                  "query_id long, query_text string")
    want = sorted(map(tuple, keyword.keyword_pairs(index, asked, syntax="web").collect()))
    taken = _in_parts(monkeypatch, 3)
    got = sorted(map(tuple, keyword.keyword_pairs(index, asked, syntax="web").collect()))
    assert taken and [x[:2] for x in got] == [x[:2] for x in want] and len(got) > 8
    assert np.allclose([x[2] for x in got], [x[2] for x in want])
    assert (0, "a") not in {x[:2] for x in got}


def test_no_row_is_made_for_a_candidate_and_a_word(spark, monkeypatch):
    """What is moved are packed postings by part and word, as many for one query as for twenty."""
    index = spark.range(3000).selectExpr("concat('c', id) chunk_id", "'common words here ' || id % 7 chunk_text", "id chunk_no")
    stored = keyword.build_postings(index)
    monkeypatch.setattr(keyword, "MAX_WANTED", 1000)
    items = [i for q in range(20) for i in keyword.plain_items(q, ["common", "words"])]
    pairs = keyword.match(stored, items, spark.range(1).selectExpr("id query_id").schema["query_id"])
    assert pairs.count() == 60_000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and plan.count("MapInArrow") >= 2
    moved = [*keyword._dealt(stored.where("term IN ('common', 'words')").select("term", "postings").toArrow().to_batches(),
                             {"common": 0, "words": 1}, 2)]
    assert sum(b.num_rows for b in moved) <= 4 * len(moved)


def test_densities_add_up_as_the_fold_does():
    at = np.array([0, 3, 4, 9, 10, 1 << 32, (1 << 32) + 5])
    got = keyword._densities(at, np.array([0, 1, 0, 0, 1, 1, 0]), np.array([0, 1]))
    assert np.allclose(got, [0.1 / 3 + 0.1 + 0.1, 0.1 / 5])
