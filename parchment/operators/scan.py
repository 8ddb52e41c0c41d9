"""Skew-safe ordered scans per key (row numbers, last known value).

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task; one source or question may hold a third of all rows.  Here the
rows are range-partitioned on ``(key, order)`` (Spark samples the bounds, so
a hot key is split over many tasks), each contiguous segment is scanned on
its own, and a small per-segment summary carries the state from earlier
segments (a parallel prefix scan).  The summary has at most
``#keys + #partitions`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.session import materialize


def _segments(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Range-partition and tag each row with its segment (task) number.

    The tagged rows are written once to the checkpoint folder: the segment
    number comes from ``spark_partition_id()``, which must not be evaluated
    again by the several branches below (AQE may coalesce each read of the
    exchange differently), and the written table also cuts the lineage.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.repartitionByRange(n, *[F.col(k) for k in keys + order]).withColumn(
        "_seg", F.spark_partition_id())
    return materialize(tagged, "segments")


def row_number_by(df: DataFrame, keys: list[str], order: list[str], out: str,
                  offset: F.Column | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` (+ optional offset column)."""
    seg = _segments(df, keys, order)
    w_local = Window.partitionBy(*keys, "_seg").orderBy(*order)
    local = seg.withColumn("_lrn", F.row_number().over(w_local))
    sizes = seg.groupBy(*keys, "_seg").agg(F.count(F.lit(1)).alias("_n"))
    w_seg = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = sizes.withColumn("_seg_base", F.coalesce(F.sum("_n").over(w_seg), F.lit(0))).drop("_n")
    res = local.join(carry, [*keys, "_seg"], "inner")
    rn = (F.col("_seg_base") + F.col("_lrn")).cast("int")
    if offset is not None:
        rn = (rn + offset).cast("int")
    return res.withColumn(out, rn).drop("_seg", "_lrn", "_seg_base")


def last_known_before(df: DataFrame, keys: list[str], order: list[str], value: str,
                      out: str) -> DataFrame:
    """Last non-null ``value`` strictly before each row in ``order`` within ``keys``."""
    seg = _segments(df, keys, order)
    ordkey = F.struct(*[F.col(c) for c in order])
    w_local = Window.partitionBy(*keys, "_seg").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    local = seg.withColumn("_lprev", F.last(value, ignorenulls=True).over(w_local))
    tails = (seg.where(F.col(value).isNotNull())
             .groupBy(*keys, "_seg")
             .agg(F.max_by(F.col(value), ordkey).alias("_tail")))
    w_seg = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    # segments that hold no non-null value still need the carry from before them
    all_segs = seg.select(*keys, "_seg").distinct()
    carry_all = (all_segs.join(tails.select(*keys, "_seg", "_tail"), [*keys, "_seg"], "left")
                 .withColumn("_carry", F.last("_tail", ignorenulls=True).over(w_seg))
                 .drop("_tail"))
    res = local.join(carry_all, [*keys, "_seg"], "left")
    return res.withColumn(out, F.coalesce(F.col("_lprev"), F.col("_carry"))).drop(
        "_seg", "_lprev", "_carry")


def running_sum_by(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                   outs: list[str]) -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` within ``keys`` (skew-safe)."""
    seg = _segments(df, keys, order)
    w_local = Window.partitionBy(*keys, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = seg
    for v, o in zip(values, outs):
        local = local.withColumn(f"_l{o}", F.sum(v).over(w_local))
    sums = seg.groupBy(*keys, "_seg").agg(*[F.sum(v).alias(f"_t{o}") for v, o in zip(values, outs)])
    w_seg = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, "_seg", *[F.coalesce(F.sum(f"_t{o}").over(w_seg), F.lit(0)).alias(f"_c{o}")
                                         for o in outs])
    res = local.join(carry, [*keys, "_seg"], "inner")
    for o in outs:
        res = res.withColumn(o, F.col(f"_l{o}") + F.col(f"_c{o}")).drop(f"_l{o}", f"_c{o}")
    return res.drop("_seg")
