"""Posting blocks and query forms against a direct reading of the texts."""

import re

import pytest

from parchment.constants import STOPWORDS
from parchment.operators import keyword

TOKEN = re.compile(r"[a-z0-9][a-z0-9'-]*")
CHUNKS = [
    ("c0", "The bank of England raised the base rate"),
    ("c1", "Bank England: the base rate of the bank of England"),
    ("c2", "river bank and river bed, base of the rate"),
    ("c3", "rate rate rate"),
    ("c4", ""),
    ("c5", "base rate base rate base"),
    ("c6", None),
] + [(f"h{i}", f"common words everywhere {'rare' if i % 97 == 0 else 'plain'} common {i}") for i in range(700)]

QUERIES = [
    '"bank of england"', '"bank england"', '"base rate" bank', "base rate", "rate", "river or raised", '"base rate" -england',
    "bank -river", "-bank", "bank or", "or bank", '"" bank', "the of", '"rate rate"', '"rate rate" base', "rate rate", "common rare",
    '"everywhere rare"', "rare or river -bed", 'base -"base rate"', '"base rate" or "base rate"', "unheard base", "unheard or base", "",
]


def _clauses(text):
    """Clauses of (negative, [(offset, word)]) items, read by hand from the text's pieces."""
    out = [[]]
    for raw in re.findall(r'-?"[^"]*"|[^\s"]+', text):
        if raw.lower() == "or":
            out.append([])
            continue
        kept = [(i, w) for i, w in enumerate(TOKEN.findall(raw.lower())) if w not in STOPWORDS]
        if kept:
            item = (raw.startswith("-"), [(i - kept[0][0], w) for i, w in kept])
            out[-1] += [item] if item not in out[-1] else []
    return [c for i, c in enumerate(out) if c not in out[:i]]


def _score(text, chunk):
    words = TOKEN.findall((chunk or "").lower())
    total = 0.0
    for clause in _clauses(text):
        places = []
        for negative, item in clause:
            at = [p for p in range(len(words)) if all(p + o < len(words) and words[p + o] == w for o, w in item)]
            places.append((negative, at))
        wanted = [at for negative, at in places if not negative]
        if not wanted or not all(wanted) or any(at for negative, at in places if negative):
            continue
        occ = sorted((p, i) for i, at in enumerate(wanted) for p in at)
        best = -1
        for e in range(len(occ)):
            start = min(max((j for j in range(e + 1) if occ[j][1] == i), default=-1) for i in range(len(wanted)))
            if start > best:
                best = start
                total += 0.1 / (1 + (occ[e][0] - occ[start][0]) - (e - start))
    return total


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(CHUNKS, "chunk_id string, chunk_text string").repartition(5)


@pytest.fixture(scope="module")
def postings(index):
    return keyword.build_postings(index).cache()


def test_posting_blocks(postings):
    want = {}
    for c, text in CHUNKS:
        for p, w in enumerate(TOKEN.findall((text or "").lower())):
            want.setdefault(w, {}).setdefault(c, []).append(p)
    got, sizes = {}, {}
    for r in postings.collect():
        assert r.df == len(want[r.term])
        sizes.setdefault(r.term, []).append(len(r.postings))
        for x in r.postings:
            assert x.chunk_id not in got.setdefault(r.term, {})
            got[r.term][x.chunk_id] = list(x.positions)
    assert got == want
    assert len(sizes["common"]) == 8 and max(sizes["common"]) < 200  # a frequent term is spread over blocks


def test_query_forms(spark, index, postings):
    asked = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, query_text string")
    got = {(r.query_id, r.chunk_id): r.keyword_score for r in keyword.keyword_pairs(index, asked, postings, syntax="web").collect()}
    want = {(q, c): s for q, text in enumerate(QUERIES) for c, chunk in CHUNKS if (s := _score(text, chunk))}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {q for q, _ in got} >= {0, 2, 3, 4, 5, 6, 7, 13, 16, 17, 18, 19, 22}


def test_plain_queries_without_stored_index(spark, index):
    asked = spark.createDataFrame([(1, "Base RATE of the bank"), (2, "the"), (3, None), (4, "rate -bank")], "query_id long, query_text string")
    got = {(r.query_id, r.chunk_id) for r in keyword.keyword_pairs(index, asked).collect()}
    assert got == {(1, "c0"), (1, "c1"), (1, "c2"), (4, "c0"), (4, "c1"), (4, "c2")}
    quoted = index.sparkSession.createDataFrame([("a", "the bank's rock-'n-roll"), ("b", "banks")], "chunk_id string, chunk_text string")
    got = keyword.keyword_pairs(quoted, asked.selectExpr("query_id", "\"bank's rock-'n-roll\" as query_text")).collect()
    assert {r.chunk_id for r in got} == {"a"} and len(got) == 4


def test_index_scan_is_pruned(spark, postings, index):
    stored = keyword.build_postings(index)
    plan = keyword.match(stored, keyword.plain_items(1, ["rare", "common"]), spark.range(1).schema["id"].__class__(
        "query_id", spark.range(1).schema["id"].dataType))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan and "In(term, [common,rare])" in plan
