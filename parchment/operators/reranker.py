"""Supervised reranker with Spark ML.

Text features: lower-cased word tokens of two or more word characters,
English stop words removed, unigrams (and bigrams for n-gram range (1, 2)),
the ``max_features`` most frequent terms, TF-IDF with smoothed IDF plus one,
L2 normalisation; a class-balanced logistic regression.  The settings
(n-gram range x C) are chosen by Spark ML's cross-validation with folds of
whole questions, scored by average precision; the chosen model is the one
that :class:`parchment.sources.models.ModelStore` keeps and that
:func:`rerank` applies.

Mapping of the classifier's C: ``regParam = 1 / (C * sum(weights))`` with
``elasticNetParam = 0`` and no standardisation; balanced weights sum to the
number of rows.  The optimiser and the stop word list differ from other
libraries', so coefficients differ; the metrics are what is compared.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, NGram, Normalizer, RegexTokenizer,
                                SQLTransformer, StopWordsRemover)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.constants import (CANDIDATE_LIMIT, DEFAULT_TOP_K, EMBEDDING_MODEL, GRID_C, GRID_NGRAM_MAX,
                                 TFIDF_MAX_FEATURES)
from parchment.operators import evaluation
from parchment.operators.scan import row_number_by
from parchment.session import materialize

SPLITS = ("train", "validation", "test")
PARALLEL_FITS = 6  # settings of one fold fitted and scored at a time; each is a chain of small jobs


class BalancedReranker(Estimator):
    """Estimator over ``text`` and ``label`` (0 or 1); classes are balanced on the rows it is fitted on."""

    def __init__(self, ngram_max: int = 1, c: float = 1.0, max_features: int = TFIDF_MAX_FEATURES):
        super().__init__()
        self.ngramMax = Param(self, "ngramMax", "longest n-gram", TypeConverters.toInt)
        self.c = Param(self, "c", "inverse regularisation", TypeConverters.toFloat)
        self.maxFeatures = Param(self, "maxFeatures", "vocabulary size", TypeConverters.toInt)
        self._setDefault(ngramMax=ngram_max, c=c, maxFeatures=max_features)

    def _fit(self, rows: DataFrame) -> PipelineModel:
        return next(self.fitMultiple(rows, [{}]))[1]

    def fitMultiple(self, dataset: DataFrame, paramMaps) -> Iterator[tuple[int, PipelineModel]]:  # noqa: N802, N803
        """Models by index of their setting; text features do not depend on C and are fitted once per n-gram range."""
        own = [self.copy(extra) for extra in paramMaps]
        return _Fits(*balanced(dataset), [(o.getOrDefault(o.getParam("ngramMax")), o.getOrDefault(o.getParam("maxFeatures")),
                                           o.getOrDefault(o.getParam("c"))) for o in own])


class _Fits:
    """Iterator over (index, model) that several threads may share, as Spark ML's parallel cross-validation does."""

    def __init__(self, rows: DataFrame, n: int, settings: list[tuple[int, int, float]]):
        self._rows, self._n, self._settings, self._lock = rows, n, settings, threading.Lock()
        self._order = iter(sorted(range(len(settings)), key=lambda i: settings[i][:2]))
        self._features: dict = {}
        self._open = Counter(s[:2] for s in settings)

    def __iter__(self) -> _Fits:
        return self

    def __next__(self) -> tuple[int, PipelineModel]:
        with self._lock:
            i = next(self._order)
            key, c = self._settings[i][:2], self._settings[i][2]
            if key not in self._features:
                stages, featured = text_features(self._rows, *key)
                self._features[key] = stages, featured.select("features", "label", "weight").persist()
        stages, featured = self._features[key]
        model = PipelineModel([*stages, classifier(c, self._n).fit(featured)])
        with self._lock:
            self._open[key] -= 1
            if not self._open[key]:
                featured.unpersist()
        return i, model


class AveragePrecision(Evaluator):
    """Average precision of the positive class's probability."""

    def _evaluate(self, dataset: DataFrame) -> float:
        held = dataset.select("label", vector_to_array(F.col("probability"))[1].alias("probability"))
        return evaluation.average_precision(held).first()[0]

    def isLargerBetter(self) -> bool:  # noqa: N802
        return True


def balanced(examples: DataFrame) -> tuple[DataFrame, int]:
    """``weight`` = n / (2 * rows of the class), and the sum of the weights, n; both labels must occur."""
    counts = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"a fit needs examples of both labels, there are {sorted(counts, key=str)}")
    n = sum(counts.values())
    return examples.withColumn("weight", F.when(F.col("label") == 1, n / (2.0 * counts[1])).otherwise(n / (2.0 * counts[0]))), n


def text_features(rows: DataFrame, ngram_max: int, max_features: int) -> tuple[list, DataFrame]:
    """Fitted stages text -> ``features``, and ``rows`` with these."""
    terms = "_uni"
    stages = [RegexTokenizer(inputCol="text", outputCol="_tok", pattern=r"(?U)\b\w\w+\b", gaps=False, toLowercase=True),
              StopWordsRemover(inputCol="_tok", outputCol="_uni")]
    if ngram_max >= 2:
        terms = "_terms"
        stages += [NGram(n=2, inputCol="_uni", outputCol="_bi"),
                   SQLTransformer(statement="SELECT *, concat(_uni, _bi) AS _terms FROM __THIS__")]
    for s in stages:
        rows = s.transform(rows)
    counter = CountVectorizer(inputCol=terms, outputCol="_tf", vocabSize=max_features).fit(rows)
    rows = counter.transform(rows)
    idf = IDF(inputCol="_tf", outputCol="_tfidf").fit(rows).idf.toArray() + 1.0  # ln((1 + n) / (1 + df)) + 1
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    unit = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    return [*stages, counter, scale, unit], unit.transform(scale.transform(rows))


def classifier(c: float, weight_sum: float) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / (c * weight_sum),
                              elasticNetParam=0.0, standardization=False, maxIter=50, family="binomial")


def positive_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The columns of ``df`` (an earlier ``probability`` is replaced) and the positive class's ``probability``."""
    keep = [c for c in df.columns if c != "probability"]
    return model.transform(df.select(*keep)).select(*keep, vector_to_array(F.col("probability"))[1].alias("probability"))


def with_folds(examples: DataFrame, n_folds: int) -> DataFrame:
    """``fold``: whole questions, dealt in turn from the one with most examples on, so that no fold is empty."""
    sizes = examples.groupBy("question_id").agg((-F.count(F.lit(1))).alias("size"))
    dealt = row_number_by(sizes, [], ["size", "question_id"], "place")
    return examples.join(dealt.select("question_id", ((F.col("place") - 1) % n_folds).cast("int").alias("fold")), "question_id")


def select_model(train: DataFrame, grid_ngram=GRID_NGRAM_MAX, grid_c=GRID_C) -> tuple[PipelineModel, list[dict]]:
    """The model of the best setting, fitted on all of ``train``, and the settings with their mean scores.

    At most 3 folds.  Of settings with equal scores the first stays (smallest C, then shortest n-grams).
    """
    n_folds = min(3, train.select("question_id").distinct().count())
    if n_folds < 2:
        raise ValueError("cross-validation needs two training questions")
    est, grid = _grid(grid_ngram, grid_c)
    # Written once: every optimiser step is a job over as many tasks as the table needs, not one for each shuffle partition.
    rows = materialize(with_folds(train, n_folds).select("text", "label", "fold"), "reranker-folds")
    found = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=AveragePrecision(), numFolds=n_folds,
                           foldCol="fold", parallelism=PARALLEL_FITS).fit(rows)
    best = max(range(len(grid)), key=lambda i: (found.avgMetrics[i], -i))
    return found.bestModel, [
        {"ngram_max": s[est.ngramMax], "c": s[est.c], "cv_average_precision": float(found.avgMetrics[i]), "selected": i == best}
        for i, s in enumerate(grid)]


def first_model(train: DataFrame, grid_ngram=GRID_NGRAM_MAX, grid_c=GRID_C) -> tuple[PipelineModel, list[dict]]:
    """The model of the first setting, for a single training question: no setting can be scored, so scores are null."""
    est, grid = _grid(grid_ngram, grid_c)
    rows = materialize(train.select("text", "label"), "reranker-question")
    return est.fit(rows, grid[0]), [
        {"ngram_max": s[est.ngramMax], "c": s[est.c], "cv_average_precision": None, "selected": i == 0} for i, s in enumerate(grid)]


def _grid(grid_ngram, grid_c) -> tuple[BalancedReranker, list[dict]]:
    """The estimator and its settings, those that win ties first."""
    est = BalancedReranker()
    grid = ParamGridBuilder().addGrid(est.c, list(grid_c)).addGrid(est.ngramMax, list(grid_ngram)).build()
    return est, sorted(grid, key=lambda s: (s[est.c], s[est.ngramMax]))


def _plain(metrics: DataFrame) -> dict:
    return {k: float(v) for k, v in metrics.first().asDict().items()}


def train_reranker(examples: DataFrame, k: int = DEFAULT_TOP_K, candidate_limit: int = CANDIDATE_LIMIT,
                   embedding_model: str = EMBEDDING_MODEL) -> tuple[PipelineModel, dict]:
    """The selected model and its record, from labelled candidates with their question's ``split``.

    The setting is chosen on the training questions, the blend weight on the
    validation questions, and the test questions are only measured.  Each
    split must hold both labels.  A single training question leaves nothing to
    choose by: the first setting is fitted.
    """
    counts = {(r["split"], r["label"]): (r["examples"], r["questions"]) for r in examples.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("examples"), F.count_distinct("question_id").alias("questions")).collect()}
    for split in SPLITS:
        if not {(split, 0), (split, 1)} <= set(counts):
            raise ValueError(f"{split} split must hold positive and negative examples")
    questions = {r["split"]: r["n"] for r in examples.groupBy("split").agg(F.count_distinct("question_id").alias("n")).collect()}
    fit = select_model if questions["train"] > 1 else first_model
    model, grid = fit(examples.where(F.col("split") == "train"))
    scored = positive_probability(model, examples.where(F.col("split") != "train").drop("fold")).persist()
    validation, test = (scored.where(F.col("split") == s) for s in SPLITS[1:])
    best = next(g for g in grid if g["selected"])
    blend = _plain(evaluation.select_weight(evaluation.blend_sweep(validation, k=k), k))
    weight = blend.pop("weight")
    pr = _plain(evaluation.precision_recall(test))
    total = {label: sum(n for (_, y), (n, _) in counts.items() if y == label) for label in (0, 1)}
    record = {
        "model": "tfidf_logistic_regression_reranker", "baseline": "hybrid_retrieval_score",
        "embedding_model": embedding_model, "candidate_limit": candidate_limit, "top_k": k,
        "question_count": sum(questions.values()), **{f"{s}_questions": questions[s] for s in SPLITS},
        **{f"{s}_examples": counts[s, 0][0] + counts[s, 1][0] for s in SPLITS},
        "positive_examples": total[1], "negative_examples": total[0],
        "best_ngram_max": best["ngram_max"], "best_c": best["c"], "selected_model_weight": weight,
        "cv_average_precision": best["cv_average_precision"],
        "test_average_precision": float(evaluation.average_precision(test).first()[0]),
        "test_precision": pr["precision"], "test_recall": pr["recall"],
        "baseline_grouped_metrics": _plain(evaluation.grouped_metrics(test, "hybrid_score", k)),
        "validation_blend_metrics": blend,
        "reranker_grouped_metrics": _plain(evaluation.grouped_metrics(
            test.withColumn("blended_score", evaluation.blend("probability", "hybrid_score", weight)), "blended_score", k)),
        "grid": grid, "leakage_control": "train/validation/test split grouped by question",
    }
    scored.unpersist()
    return model, record


def rerank(model: PipelineModel, weight: float, candidates: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """``candidates`` of each question ordered by the blended score (ties: candidate order), the first ``k``.

    At most one question's candidates (the retrieval's limit) are ranked together.
    """
    blended = positive_probability(model, candidates).withColumn(
        "blended_score", evaluation.blend("probability", "hybrid_score", weight))
    w = Window.partitionBy("question_id").orderBy(F.round("blended_score", 9).desc(), F.col("candidate_rank"))
    return blended.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
