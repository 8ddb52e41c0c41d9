"""The pipeline's stages against brute force, on a table whose extra columns carry names that stages use inside."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parchment.llm import mixing, packing, quality
from parchment.llm.queries import word_tokenizer

NAMES = ["row", "id", "gone", "hash", "sha", "place", "copies", "repeats", "nth", "__gone", "__of", "__copy", "component_id", "p_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGE = dict(corpus_pipeline.STAGES)


def _rows():
    rng = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    base = rng.choices(words, k=90)
    texts = [None, "", " ", "one two", "one  two", "one\ttwo", " ".join(rng.choices(words, k=9000))]
    for _ in range(25):
        w = list(base)
        for i in rng.sample(range(90), rng.choice([1, 1, 2, 4])):
            w[i] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(30)]
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return rows + [rows[40], (*rows[41][:5], *["other"] * len(NAMES)), (None, *rows[42][1:])]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    """An input folder: the awkward rows, and labels that tell short junk from prose."""
    folder = tmp_path_factory.mktemp("pipeline")
    junk = [(1000 + i, "@@## $$%% {}{} ~~~ ||| " * (3 + i % 7), "en", "a", 1, *["x"] * len(NAMES)) for i in range(60)]
    spark.createDataFrame(rows + junk, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    known = [(i, 1, 0) for i in range(6, 60)] + [(r[0], 0, 0) for r in junk]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def _exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()]


def _near(rows):
    sets = {}
    for r in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets[r[0]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets if d is not None}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] < root[b]:
                    root[b], changed = root[a], True
    return [r[0] for r in rows if r[0] is None or root[r[0]] == r[0]]


def test_stages_keep_all_columns_under_any_names(spark, docs, sf_dir):
    for name, apply in corpus_pipeline.STAGES[:-1]:
        got = apply(spark, docs, sf_dir)
        assert got.columns == docs.columns, name
        assert [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name


def test_exact_stage(spark, docs, rows, sf_dir):
    got = STAGE["exact_dedup"](spark, docs, sf_dir).collect()
    assert sorted(str(r[0]) for r in got) == sorted(map(str, _exact(rows)))
    again = STAGE["exact_dedup"](spark, docs.repartition(7), sf_dir).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))  # also the choice among rows that repeat doc_id and text
    assert all(tuple(r) in set(rows) for r in got)


def test_near_stage(spark, docs, rows, sf_dir):
    got = STAGE["near_dedup"](spark, docs, sf_dir).collect()
    assert sorted(str(r[0]) for r in got) == sorted(map(str, _near(rows)))
    assert all(tuple(r) in set(rows) for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_take_deals_the_copies_of_repeated_rows_exactly(spark, docs, rows, seed):
    many = docs.where("doc_id = 45")
    repeated = docs.unionByName(many).unionByName(many).unionByName(many.withColumn("id", F.lit("z")))
    mixed = mixing.mix(repeated, seed=seed)
    wanted = collections.Counter()
    for r in mixed.where("taken > 0").collect():
        wanted[r.doc_id] += r.copies
    got = mixing.take(repeated, mixed).collect()
    assert collections.Counter(r[0] for r in got) == wanted
    each = collections.Counter(tuple(r) for r in got if r[0] == 45)
    assert sum(each.values()) == wanted[45]


def test_whole_run(spark, sf_dir):
    """Every stage's decisions take effect: the run packs what the stages, applied by hand, leave."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    rows = [tuple(r) for r in docs.collect() if r[0] in good]
    assert not [r for r in rows if (r[0] or 0) >= 1000] and len([r for r in rows if 6 <= (r[0] or 0) < 60]) > 45
    keep = set(_exact(rows))
    rows = list({r[0]: r for r in rows if r[0] in keep}.values())
    keep = set(_near(rows))
    left = docs.where(F.col("doc_id").isin([d for d in keep if d is not None])).dropDuplicates(["doc_id"])
    taken = {r.doc_id: r.copies for r in mixing.mix(left, mixing.lexical_quality("text")).where("taken > 0").collect()}
    size = {r.doc_id: r.length for r in packing.pack(left, word_tokenizer()).groupBy("doc_id").agg(F.sum("length").alias("length")).collect()}
    got = corpus_pipeline.run(spark, sf_dir).groupBy("doc_id").agg(F.sum("length").alias("length")).collect()
    assert {r.doc_id: r.length for r in got} == {d: n * size[d] for d, n in taken.items()}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
