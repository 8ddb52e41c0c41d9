"""Retrieval evaluation and ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.constants import (BLEND_WEIGHTS, DEFAULT_TOP_K, RANDOM_STATE, TEST_SIZE, VALIDATION_SIZE)
from parchment.operators.scan import row_number_by, running_sum_by


def expectation_match(title, source_url, agency, exp_title, exp_url, exp_agency) -> F.Column:
    """lower-case contains on title and agency, exact URL; empty expectations match."""
    def empty(c):
        return F.coalesce(F.col(c), F.lit("")) == ""
    return ((empty(exp_title) | F.contains(F.lower(F.col(title)), F.lower(F.col(exp_title))))
            & (empty(exp_url) | (F.col(exp_url) == F.col(source_url)))
            & (empty(exp_agency) | F.contains(F.lower(F.col(agency)), F.lower(F.col(exp_agency)))))


def question_outcomes(results: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question: matched, first relevant rank and the top row.

    ``results``: ranked retrieval rows (``query_id`` = question id, ``rank``).
    Questions without any result row still appear (no match, no top row).
    """
    q = questions.select(F.col("question_id").alias("query_id"), "expected_title_contains",
                         "expected_source_url", "expected_agency")
    r = results.join(q, "query_id", "inner").withColumn(
        "_match", expectation_match("title", "source_url", "agency", "expected_title_contains",
                                    "expected_source_url", "expected_agency"))
    per_q = r.groupBy("query_id").agg(
        F.min(F.when(F.col("_match"), F.col("rank"))).alias("first_relevant_rank"),
        F.min_by(F.struct(F.col("title").alias("top_title"), F.col("source_url").alias("top_source_url"),
                          F.col("hybrid_score").alias("top_hybrid_score")), F.col("rank")).alias("_top"))
    out = questions.select(F.col("question_id").alias("query_id"), "question_text").join(per_q, "query_id", "left")
    return out.select(F.col("query_id").alias("question_id"), "question_text",
                      F.col("first_relevant_rank").isNotNull().alias("matched"),
                      F.col("first_relevant_rank").cast("int").alias("first_relevant_rank"),
                      "_top.top_title", "_top.top_source_url", "_top.top_hybrid_score")


def evaluation_summary(outcomes: DataFrame) -> DataFrame:
    """Question count, hits, hit rate and MRR (misses count 0; no questions -> 0.0)."""
    n = F.count(F.lit(1))
    return outcomes.agg(
        n.alias("question_count"),
        F.count_if("matched").alias("hit_count"),
        F.coalesce(F.count_if("matched") / F.when(n > 0, n), F.lit(0.0)).alias("hit_rate"),
        F.coalesce(F.sum(F.coalesce(1.0 / F.col("first_relevant_rank"), F.lit(0.0))) / F.when(n > 0, n),
                   F.lit(0.0)).alias("mean_reciprocal_rank"))


def grouped_metrics(scored: DataFrame, score: str, k: int = DEFAULT_TOP_K, group: str = "question_id",
                    tie: str = "candidate_rank") -> DataFrame:
    """hit@k, MRR and mean precision@k over questions.

    Rows are ranked per question by ``score`` rounded to 9 digits (descending;
    ties keep the candidate order).  Precision divides by the rows returned (at most k).
    Per question at most the candidates of one question are ranked (bounded
    by the candidate limit).
    """
    w = Window.partitionBy(group).orderBy(F.round(F.col(score), 9).desc(), F.col(tie).asc())
    top = scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    per_q = top.groupBy(group).agg(
        F.min(F.when(F.col("label") == 1, F.col("_r"))).alias("_first"),
        (F.sum("label") / F.count(F.lit(1))).alias("_prec"))
    n = F.count(F.lit(1))
    return per_q.agg(
        n.alias("questions"),
        F.coalesce(F.count_if(F.col("_first").isNotNull()) / F.when(n > 0, n), F.lit(0.0)).alias(f"hit_rate_at_{k}"),
        F.coalesce(F.sum(F.coalesce(1.0 / F.col("_first"), F.lit(0.0))) / F.when(n > 0, n), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.sum("_prec") / F.when(n > 0, n), F.lit(0.0)).alias(f"precision_at_{k}"))


def grouped_split(questions: DataFrame, validation_size: float = VALIDATION_SIZE,
                  test_size: float = TEST_SIZE, random_state: int = RANDOM_STATE,
                  text: str = "question_text") -> DataFrame:
    """Deterministic shuffle (seeded SHA-256 order), then validation, test, rest train.

    Sizes are ``max(1, round_half_even(n * size))``; an error is raised when
    no training question would remain.  The global numbering is skew-safe
    (range partitioned), never one task.
    """
    keyed = questions.withColumn("_shuffle", F.sha2(F.concat(F.lit(f"{random_state}:"), F.col(text)), 256))
    n = questions.count()  # one scalar
    vc = max(1, _round_half_even(n * validation_size))
    tc = max(1, _round_half_even(n * test_size))
    if vc + tc >= n:
        raise ValueError(f"no question is left for training: {vc} + {tc} of {n} are held out")
    numbered = row_number_by(keyed, [], ["_shuffle", text], "_pos")
    split = (F.when(F.col("_pos") <= vc, "validation").when(F.col("_pos") <= vc + tc, "test").otherwise("train"))
    return numbered.withColumn("split", split).drop("_shuffle")


def _round_half_even(x: float) -> int:
    return int(round(x))


def split_label_check(examples: DataFrame, splits: DataFrame, raise_on_fail: bool = False) -> DataFrame:
    """positives/negatives per split; each split must hold both labels."""
    counts = examples.join(splits.select("question_id", "split"), "question_id").groupBy("split").agg(
        F.sum("label").cast("long").alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"),
        (F.count_distinct("label") == 2).alias("has_both_labels"))
    if not raise_on_fail:
        return counts
    # Splits without any example are missing from the counts, so start from the three names; the failing
    # branch feeds an output column, which the optimizer must keep.
    names = examples.sparkSession.createDataFrame([("train",), ("validation",), ("test",)], "split string")
    out = names.join(counts, "split", "left").select(
        "split", "positives", "negatives",
        F.when(F.coalesce("has_both_labels", F.lit(False)), True).otherwise(F.raise_error(F.concat(
            F.lit("one label is missing in split "), F.col("split"))).cast("boolean")).alias("has_both_labels"))
    return out


def blend(prob, hybrid, weight) -> F.Column:
    """``w * p + (1 - w) * hybrid``."""
    w = weight if isinstance(weight, F.Column) else F.lit(weight)
    return w * F.col(prob) + (F.lit(1.0) - w) * F.col(hybrid)


def blend_sweep(scored: DataFrame, prob: str = "probability", hybrid: str = "hybrid_score",
                k: int = DEFAULT_TOP_K, weights: tuple = BLEND_WEIGHTS) -> DataFrame:
    """Grouped metrics for every weight 0.0..1.0 (one job: the weight grid is a column)."""
    crossed = (scored.withColumn("weight", F.explode(F.array(*[F.lit(float(w)) for w in weights])))
               .withColumn("_s", blend(prob, hybrid, F.col("weight"))))
    w = Window.partitionBy("weight", "question_id").orderBy(F.round("_s", 9).desc(), F.col("candidate_rank").asc())
    top = crossed.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    per_q = top.groupBy("weight", "question_id").agg(
        F.min(F.when(F.col("label") == 1, F.col("_r"))).alias("_first"),
        (F.sum("label") / F.count(F.lit(1))).alias("_prec"))
    n = F.count(F.lit(1))
    return per_q.groupBy("weight").agg(
        n.alias("questions"),
        (F.count_if(F.col("_first").isNotNull()) / n).alias(f"hit_rate_at_{k}"),
        (F.sum(F.coalesce(1.0 / F.col("_first"), F.lit(0.0))) / n).alias("mrr"),
        (F.sum("_prec") / n).alias(f"precision_at_{k}"))


def select_weight(sweep: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """Lexicographic best (mrr, hit rate, precision); ties go to the lowest weight."""
    key = F.struct(F.col("mrr"), F.col(f"hit_rate_at_{k}"), F.col(f"precision_at_{k}"), (-F.col("weight")).alias("nw"))
    best = sweep.agg(F.max_by(F.struct(*sweep.columns), key).alias("b"))
    return best.select("b.*")


def average_precision(scored: DataFrame, label: str = "label", score: str = "probability",
                      group: list[str] | None = None) -> DataFrame:
    """Step-wise average precision, ``sum_t (R_t - R_{t-1}) * P_t`` over score thresholds.

    Rows with equal scores form one threshold.  Computed by grouping on the
    score, a running sum over thresholds and one aggregate.
    """
    group = group or []
    by_t = (scored.groupBy(*group, score).agg(F.sum(label).cast("long").alias("_tp"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_neg", -F.col(score)))
    run = running_sum_by(by_t, group, ["_neg"], ["_tp", "_n"], ["_ctp", "_cn"])
    tot = scored.groupBy(*group).agg(F.sum(label).cast("long").alias("_P"))
    run = run.join(tot, group, "inner") if group else _attach_total(run, tot)
    return run.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(F.col("_P") > 0, (F.col("_tp") / F.col("_P")) * (F.col("_ctp") / F.col("_cn")))),
                   F.lit(0.0)).alias("average_precision"))


def _attach_total(run: DataFrame, tot: DataFrame) -> DataFrame:
    """Attach a one-row total as a literal (no join needed)."""
    total = tot.collect()[0]["_P"] or 0
    return run.withColumn("_P", F.lit(total))


def precision_recall(scored: DataFrame, label: str = "label", score: str = "probability",
                     threshold: float = 0.5) -> DataFrame:
    """Precision and recall at ``score >= threshold`` (zero division -> 0)."""
    pred = F.col(score) >= threshold
    tp = F.count_if(pred & (F.col(label) == 1))
    fp = F.count_if(pred & (F.col(label) == 0))
    fn = F.count_if(~pred & (F.col(label) == 1))
    return scored.agg(
        F.coalesce(tp / F.when(tp + fp > 0, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(tp / F.when(tp + fn > 0, tp + fn), F.lit(0.0)).alias("recall"),
        tp.alias("true_positives"), fp.alias("false_positives"), fn.alias("false_negatives"))
