"""The reranker's chain: folds, selection, record, store, application, recomputed in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parchment.operators import evaluation, reranker
from parchment.sources.models import ModelStore

SCHEMA = "question_id long, candidate_rank int, text string, label int, hybrid_score double, split string"


@pytest.fixture(scope="module")
def examples(spark):
    rng = random.Random(1)
    rows = []
    for q in range(24):
        split = "train" if q < 14 else "validation" if q < 19 else "test"
        for i in range(6 + q % 4):
            label = int(i in (3, 5))
            words = rng.choices(["tariff", "filing", "rebate"] if label else ["weather", "garden", "music"], k=4)
            rows.append((q, i + 1, " ".join([*words, *rng.choices(["plain", "common", "note"], k=3)]), label, 1.0 - i / 20, split))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def _average_precision(rows):
    total = tp = n = 0
    positives = sum(r.label for r in rows)
    for p in sorted({r.probability for r in rows}, reverse=True):
        tied = [r.label for r in rows if r.probability == p]
        tp, n = tp + sum(tied), n + len(tied)
        total += sum(tied) / positives * tp / n
    return total


def _grouped(rows, score):
    first, precision = [], []
    for q in {r.question_id for r in rows}:
        top = sorted((r for r in rows if r.question_id == q), key=lambda r: (-round(score(r), 9), r.candidate_rank))[:5]
        first.append(next((i for i, r in enumerate(top, 1) if r.label == 1), None))
        precision.append(sum(r.label for r in top) / len(top))
    return {"questions": len(first), "hit_rate_at_5": sum(f is not None for f in first) / len(first),
            "mrr": sum(1 / f for f in first if f) / len(first), "precision_at_5": sum(precision) / len(precision)}


def test_folds_hold_whole_questions_and_none_is_empty(spark, examples):
    for n in (2, 3):
        folds = reranker.with_folds(examples, n)
        assert folds.count() == examples.count()
        assert folds.groupBy("question_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
        sizes = [r.n for r in folds.groupBy("fold").agg(F.count_distinct("question_id").alias("n")).collect()]
        assert len(sizes) == n and max(sizes) - min(sizes) <= 1
    few = examples.where("question_id < 3")  # as many folds as questions
    assert sorted(r.fold for r in reranker.with_folds(few, 3).select("fold").distinct().collect()) == [0, 1, 2]


def test_features_are_smoothed_unit_tf_idf(spark):
    texts = ["Alpha beta beta the", "alpha gamma", "x gamma GAMMA beta"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, i int")
    stages, featured = reranker.text_features(rows, 1, 100)
    names = stages[2].vocabulary
    df = {"alpha": 2, "beta": 2, "gamma": 2}
    assert set(names) == set(df)  # the stop word and the single letter are gone
    for r in featured.collect():
        words = [w for w in texts[r.i].lower().split() if w in df]
        raw = {w: words.count(w) * (math.log(4 / (1 + df[w])) + 1) for w in df}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        assert list(r.features.toArray()) == pytest.approx([raw[w] / norm for w in names])


def test_class_weights_are_those_of_the_rows_fitted(spark, examples):
    part = examples.where("question_id < 5")
    rows, n = reranker.balanced(part)
    by = {r.label: r.w for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert n == part.count() and by == pytest.approx({0: n / 2, 1: n / 2})
    with pytest.raises(ValueError, match="both labels"):
        reranker.balanced(part.where("label = 0"))


def test_chain(spark, examples, tmp_path):
    model, record = reranker.train_reranker(examples)
    assert len(record["grid"]) == 6 and sum(g["selected"] for g in record["grid"]) == 1
    best = max(g["cv_average_precision"] for g in record["grid"])
    first = next(g for g in record["grid"] if g["cv_average_precision"] == best)  # ties: the first setting
    assert first["selected"] and (record["best_c"], record["best_ngram_max"]) == (first["c"], first["ngram_max"])
    store = ModelStore(spark, f"{tmp_path}/store")
    store.save("reranker", model, {"old": True})
    store.save("reranker", model, record)
    store.save("other", model, {})
    loaded, kept = store.load("reranker")
    assert kept == record and store.records().count() == 2
    with pytest.raises(KeyError):
        store.load("absent")
    held = examples.where("split <> 'train'")
    rows = reranker.positive_probability(loaded, held).collect()
    before = {(r.question_id, r.candidate_rank): r.probability for r in reranker.positive_probability(model, held).collect()}
    assert {(r.question_id, r.candidate_rank): r.probability for r in rows} == before
    test = [r for r in rows if r.split == "test"]
    validation = [r for r in rows if r.split == "validation"]

    def blended(weight):
        return lambda r: weight * r.probability + (1 - weight) * r.hybrid_score

    sweep = [(w / 10, _grouped(validation, blended(w / 10))) for w in range(11)]
    chosen = max(sweep, key=lambda s: (round(s[1]["mrr"], 12), s[1]["hit_rate_at_5"], round(s[1]["precision_at_5"], 12), -s[0]))
    assert record["selected_model_weight"] == chosen[0] and record["validation_blend_metrics"] == pytest.approx(chosen[1])
    assert record["baseline_grouped_metrics"] == pytest.approx(_grouped(test, lambda r: r.hybrid_score))
    assert record["reranker_grouped_metrics"] == pytest.approx(_grouped(test, blended(chosen[0])))
    assert record["test_average_precision"] == pytest.approx(_average_precision(test))
    called = [r for r in test if r.probability >= 0.5]
    assert record["test_precision"] == pytest.approx(sum(r.label for r in called) / len(called))
    assert record["test_recall"] == pytest.approx(sum(r.label for r in called) / sum(r.label for r in test))
    assert record["test_examples"] == len(test) and record["train_questions"] == 14
    assert record["test_average_precision"] > 0.95  # the words tell the labels apart
    got = reranker.rerank(loaded, chosen[0], examples.where("split = 'test'")).collect()
    for q in {r.question_id for r in test}:
        order = sorted((r for r in test if r.question_id == q), key=lambda r: (-round(blended(chosen[0])(r), 9), r.candidate_rank))
        assert [r.candidate_rank for r in sorted((g for g in got if g.question_id == q), key=lambda g: g["rank"])] == [
            r.candidate_rank for r in order[:5]]


def test_a_split_without_both_labels_is_refused(spark, examples):
    with pytest.raises(ValueError, match="validation split"):
        reranker.train_reranker(examples.where("split <> 'validation' or label = 0"))
    with pytest.raises(ValueError, match="two training questions"):
        reranker.select_model(examples.where("question_id = 0"))
    assert evaluation.average_precision(examples.where("label = 0").withColumn("probability", F.lit(0.5))).first()[0] == 0


def test_a_single_training_question_fits_the_first_setting(spark, examples):
    one = examples.where("split = 'train'").agg(F.min("question_id")).first()[0]
    model, record = reranker.train_reranker(examples.where((F.col("split") != "train") | (F.col("question_id") == one)))
    assert record["train_questions"] == 1 and record["cv_average_precision"] is None
    assert [g["selected"] for g in record["grid"]] == [True] + 5 * [False] and (record["best_c"], record["best_ngram_max"]) == (0.3, 1)
    assert reranker.positive_probability(model, examples).where("probability between 0 and 1").count() == examples.count()
