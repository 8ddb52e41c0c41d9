"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets are words per source: a share of the total by weight, at most
``max_epochs`` times the source, the excess reshared by weight.  A source is
taken in complete epochs first; the rest of its target is filled by the
documents with the smallest exponential keys -ln(u) / quality, summed in key
order up to the budget.

A source may hold a third of all rows, so it is never one window: keys are
cut into slices (monotone in the key, about ``SLICE_ROWS`` rows each), slices
are summed first, and only the slice sums are scanned per source.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import NO_ID, row_order, stage, whole
from parchment.operators.scan import row_number_by

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SLICE_ROWS = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from (source, source_size) rows.

    Sources in code-point order (null last) take the weights in turn.  The
    resharing loop collects scalars only; each round at least one more source
    reaches its cap.
    """
    spark = sizes.sparkSession
    ordered = sizes.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda x: (x[0]["source"], x[0]["source_size"], float(weights[x[1] % len(weights)])))
    rows = stage(spark.createDataFrame(ordered, "source string, source_size long, weight double"), "mix-sources")
    cap = F.col("source_size") * max_epochs
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget = min(share, max_epochs) * total
    level = 0.0
    for _ in itertools.count():
        capped = cap <= F.col("weight") * level
        spent, open_weight = rows.agg(F.sum(F.when(capped, cap).otherwise(0.0)),
                                      F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        raised = (budget - spent) / open_weight
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return rows.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def slice_of(key: F.Column, n_slices: int) -> F.Column:
    """The slice of a key: even parts of each octave.

    ln(key) = ln(-ln(u)) - ln(quality), and the density of the first term is at
    most 1/e, so whatever the weights are, a part of an octave's n-th holds at
    most ln(2) / e / n of a source's rows on average.
    """
    return F.floor(F.log2(F.greatest(key, F.lit(1e-300))) * (n_slices / 3))


def mix(docs: DataFrame, quality: F.Column | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        max_epochs: float = MAX_EPOCHS, seed: int = 11) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, and ``text_hash``: one row per row of ``docs``.

    ``size`` is the number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0).
    ``quality`` (positive; null counts as 1) weighs a document's chance within
    its source.  ``taken`` = copies * size; copies are the complete epochs plus
    one for the documents that fill the rest: the prefix up to the budget, with
    the document on its edge taken if at least half of it fits.  Null source
    is a source of its own, the last.  Rows with equal doc_id and text get
    equal keys and follow each other in any order.  A document of size 0
    is taken 0 words.  Empty table: empty result.  Other columns of ``docs``
    are not read.
    """
    q = F.lit(1.0) if quality is None else F.when(quality > 0, quality.cast("double")).otherwise(F.lit(1.0))
    text_hash = F.xxhash64(F.col(text))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id).cast("long"), text_hash), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = stage(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), text_hash.alias("text_hash"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        (-F.log(uniform) / q).alias("key")), "mix-rows")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = targets(by_source.select("source", "source_size"), weights, share, max_epochs)
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)) + 1e-9)
    goal = goal.select(F.col("source").alias("t_source"), "source_size", "target", epochs.alias("epochs"),
                       F.greatest(F.col("target") - epochs * F.col("source_size"), F.lit(0.0)).alias("rest"))
    n_slices = rows.count() // SLICE_ROWS + 1
    cut = rows.withColumn("slice", slice_of(F.col("key"), n_slices))
    sums = cut.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before_slice"))
    sums = sums.join(goal, F.col("s_source").eqNullSafe(F.col("t_source")))
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    picked = (cut.withColumn("in_slice", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice"))))
    fits = F.col("before_slice") + F.col("in_slice") + F.col("size") / 2 <= F.col("rest")
    copies = (F.col("epochs") + F.when(fits & (F.col("epochs") < max_epochs) & (F.col("rest") > 0), 1).otherwise(0)).cast("int")
    return picked.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                         copies.alias("copies"), "text_hash")


def take(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, with all columns, whatever their names.

    Documents taken 0 words go.  Rows that repeat doc_id and text share the
    copies of theirs: each gets an even part, and the first by row hash one
    more until all are dealt.
    """
    plan = stage(mixed.groupBy(F.col("doc_id").alias("p_id"), F.col("text_hash").alias("p_hash")).agg(
        F.sum(F.when(F.col("taken") > 0, F.col("copies")).otherwise(0)).alias("copies"),
        F.count(F.lit(1)).alias("repeats")).where("copies > 0"), "mix-plan")

    def rows(part: DataFrame, **more) -> DataFrame:
        found = whole(docs, id=F.col(doc_id).cast("long"), hash=F.xxhash64(F.col(text)), **more)
        return found.join(part, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("hash") == F.col("p_hash")))

    uneven = F.col("copies") % F.col("repeats") != 0
    dealt = rows(plan.where(~uneven)).select("row", F.expr("copies div repeats").alias("n"))
    if not plan.where(uneven).isEmpty():
        some = rows(plan.where(uneven), place=row_order(docs)).withColumn("key", F.coalesce("id", F.lit(NO_ID)))
        some = row_number_by(some, ["key", "hash"], ["place"], "nth")
        dealt = dealt.unionByName(some.select(
            "row", (F.expr("copies div repeats") + (F.col("nth") <= F.col("copies") % F.col("repeats")).cast("long")).alias("n")))
    return dealt.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")


def lexical_quality(text: str) -> F.Column:
    """A document weight in (0, 1] from the text alone: the share of bytes that are not marks such as #, |, %, &."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0))
    clean = F.coalesce(F.octet_length(F.translate(F.col(text), "#$%&*+/<=>@[\\]^_`{|}~!", "")), F.lit(0))
    return (clean + 1) / (size + 1)
