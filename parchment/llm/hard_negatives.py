"""Hard-negative mining by threshold joins over a pruned inverted index.

An anchor's positives are its best rows of the same label; for each positive
the best rows of other labels are wanted whose score lies in a window below
the positive's.  Both are threshold joins: all pairs with a score of at least
``low``, solved with rising effort as ``low`` falls.  A round asks for pairs
above a high threshold; the windows that fill are done (whatever lies above
the threshold has been seen), the others go into the next round with a lower
one, the last of which reaches the window's own end.

Within a round, boxes of anchors meet boxes of rows.  For the box's lowest
threshold an index is built over the rows' dimensions, the weakest
dimensions first: leading dimensions of a row whose norm, times the anchors'
largest norm, stays under the threshold are left out (no pair can reach it on
them alone).  The posting lists are gone through from the last dimension on;
partial scores accumulate, and after each run of dimensions a row goes when no
anchor's partial score plus the product of the two remaining norms reaches
the anchor's threshold.  Survivors get the left-out part added exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import BLOCK_ROWS, discard, stage

ANCHOR_BOX, ROW_BOX = 256, 4096
#: Thresholds of the rounds: shares of the largest possible score (positives) and of the largest positive's score (negatives).
POSITIVE_ROUNDS, NEGATIVE_ROUNDS = (0.7, 0.45, 0.25), (0.95, 0.88)
_RUN = 8  # dimensions between two prunings
_SLACK = 1 + 1e-9  # norms are rounded, bounds must not be
_MOST = (1 << 63) - 1
_BOX = "box long, n int, top double, data binary"


def _boxes(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows gathered into boxes of at most ``rows``, each one an Arrow table in a cell, with its vectors' largest squared norm."""

    def cut(batches):
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def out():
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            top = pc.max(table["power"]).as_py() if table.num_rows else 0.0
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([n], pa.int32()), pa.array([top], pa.float64()),
                                    pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["box", "n", "top", "data"])

        for batch in batches:
            first = 0
            while first < batch.num_rows:
                held.append(batch.slice(first, rows - n))
                first, n = first + held[-1].num_rows, n + held[-1].num_rows
                if n == rows:
                    yield out()
                    held, n, number = [], 0, number + 1
        if n:
            yield out()

    return stage(df.mapInArrow(cut, _BOX), name)


def _opened(data: bytes) -> tuple[pa.Table, np.ndarray]:
    """A box's table and its (n, dimensions) weights; shorter vectors end in zeros."""
    table = pa.ipc.open_stream(data).read_all().combine_chunks()
    column = table["weights"].combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return table, out


def reach(asks: np.ndarray, low: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(asks, rows) inner products; a pair whose score is under its ask's ``low`` may have -inf instead.

    Weights are whole numbers.  Where scores may leave the range in which
    doubles are exact, they are computed with arbitrary-precision integers and
    clamped to 64 bits.
    """
    d = max(asks.shape[1], rows.shape[1])
    asks, rows = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (asks, rows))
    if np.abs(asks).max(initial=0) * np.abs(rows).max(initial=0) * max(1, d) >= 1 << 53:
        q, x = (np.array([[int(v) for v in r] for r in m], object).reshape(len(m), d) for m in (asks, rows))
        return np.minimum(np.maximum(q @ x.T, -_MOST - 1), _MOST).astype(np.int64)
    least = low.min(initial=np.inf)
    if not least > 0:  # no bound can leave anything out
        return asks @ rows.T
    order = np.argsort((rows * rows).sum(0), kind="stable")  # weak dimensions lead
    asks, rows = asks[:, order], rows[:, order]
    ask_norm, row_norm = (np.sqrt(np.cumsum(np.pad(m * m, ((0, 0), (1, 0))), 1)) * _SLACK for m in (asks, rows))
    left_out = (row_norm[:, 1:] * ask_norm[:, -1].max(initial=0) < least).sum(1)  # leading dimensions not indexed
    posted = np.where(np.arange(d) >= left_out[:, None], rows, 0.0)
    alive = np.flatnonzero(left_out < d)
    scores = np.full((len(asks), len(rows)), -np.inf)
    part = np.zeros((len(asks), len(alive)))
    for last in range(d, 0, -_RUN):
        first = max(0, last - _RUN)
        has = left_out[alive] < last
        part[:, has] += asks[:, first:last] @ posted[alive[has], first:last].T
        rest = np.maximum(first, left_out[alive])  # leading dimensions still to come, or left out
        can = (part + ask_norm[:, rest] * row_norm[alive, rest] >= low[:, None]).any(0)
        if not can.all():
            alive, part = alive[can], part[:, can]
        if not len(alive):
            return scores
    scores[:, alive] = part + asks @ (rows[alive] - posted[alive]).T
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, fits: np.ndarray, low, high, k: int) -> np.ndarray:
    """Positions of the k best rows with low <= score <= high, ties to the smaller id."""
    at = np.flatnonzero(fits & (scores >= low) & (scores <= high))
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    down = ~scores[at] if scores.dtype == np.int64 else -scores[at]
    return at[np.lexsort((ids[at], down))][:k]


def _round(asks: DataFrame, rows: DataFrame, cells: int, k: int, same_label: bool) -> DataFrame:
    """ask, key, rank, vec_id, score: the ``k`` best rows of each ask and window at or above max(low, the window's floor)."""
    boxes = _boxes(asks, ANCHOR_BOX, "negatives-asks")
    dealt = boxes.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.col("data").alias("asked"))

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (asked, q), (table, x) = _opened(row["asked"]), _opened(row["data"])
                low = asked["low"].to_numpy()
                scores = reach(q, low, x)
                ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
                out = [[], [], [], []]
                for i, ask in enumerate(asked.select(["ask", "vec_id", "label", "windows"]).to_pylist()):
                    fits = ((labels == ask["label"]) == same_label) & (ids != ask["vec_id"])
                    for w in ask["windows"]:
                        at = _best(scores[i], ids, fits, max(low[i], w["floor"]), w["high"], k)
                        out[0].append(np.full(len(at), ask["ask"])), out[1].append(np.full(len(at), w["key"]))
                        out[2].append(ids[at]), out[3].append(scores[i][at].astype(np.int64))
                yield pa.record_batch([pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in out],
                                      names=["ask", "key", "vec_id", "score"])

    pairs = rows.withColumn("cell", F.pmod(F.xxhash64("box"), F.lit(cells)).cast("int")).join(dealt, "cell").select("data", "asked")
    order = Window.partitionBy("ask", "key").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = stage(pairs.mapInArrow(meet, "ask long, key long, vec_id long, score long")
                 .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "negatives-best", BLOCK_ROWS)
    discard(boxes)
    return best


def _search(asks: DataFrame, rows: DataFrame, cells: int, k: int, same_label: bool, thresholds) -> DataFrame:
    """Rounds until every window of ``asks`` (ask, vec_id, label, weights, power, cap, windows) is filled or searched to its floor."""
    done, pending = [], asks
    for share in (*thresholds, None):
        floor = F.array_min(F.transform("windows", lambda w: w["floor"].cast("double")))
        low = floor if share is None else F.greatest(F.lit(share) * F.col("cap"), floor)
        best = _round(pending.withColumn("low", low), rows, cells, k, same_label)
        if share is None:
            done.append(best)
            break
        # a window is finished when it is full, or when the threshold was at or under its floor
        full = best.where(F.col("rank") == k).groupBy("ask").agg(F.collect_set("key").alias("full"))
        rest = stage(pending.withColumn("low", low).join(full.withColumnRenamed("ask", "f_ask"), F.col("ask") == F.col("f_ask"), "left").withColumn(
            "open", F.filter("windows", lambda w: (w["floor"] < F.col("low")) & ~F.coalesce(F.array_contains("full", w["key"]), F.lit(False)))),
            "negatives-pending")
        still = rest.select(F.col("ask").alias("o_ask"), F.explode("open.key").alias("o_key"))
        done.append(best.join(still, (F.col("ask") == F.col("o_ask")) & (F.col("key") == F.col("o_key")), "left_anti"))
        pending = rest.where(F.size("open") > 0).withColumn("windows", F.col("open")).select(asks.columns)
        if pending.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(vectors: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 5,
                   window: tuple[int, int] = (80, 100), scale: float = 256.0, vec_id: str = "vec_id",
                   embedding: str = "embedding", label: str | F.Column = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Weights are floor(scale * x), x as double; a score is the integer inner
    product (beyond 64 bits clamped).  An anchor's positives are the best
    ``positives`` rows of its label; for each, the best ``negatives`` rows of
    other labels with window[0] * positive_score <= 100 * negative_score <=
    window[1] * positive_score.  Higher scores come first, ties by smaller
    vec_id.  Rows with the anchor's own id are neither.  Rows without id or
    label, null vectors and vectors with null or non-finite components take
    no part; shorter vectors end in zeros.  Repeated rows each count, and each
    repeated anchor row gets its own lists.  A positive with no row in its
    window (always so for a negative score) has none in the result.  Empty
    table: empty result.  Other columns are not read.
    """
    valid = F.forall(F.col("e"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = label if isinstance(label, F.Column) else F.col(label)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), own.cast("long").alias("label"),
                          F.col(embedding).cast("array<double>").alias("e"), is_anchor.alias("is_anchor"))
    rows = rows.where("vec_id is not null and label is not null and e is not null").where(valid)

    def weigh(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int32)
            power = np.bincount(np.repeat(np.arange(len(lists)), np.diff(cuts)), flat * flat, minlength=len(lists))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)),
                                   pa.array(power), batch.column(3)], names=["vec_id", "label", "weights", "power", "is_anchor"])

    weighed = rows.mapInArrow(weigh, "vec_id long, label long, weights array<double>, power double, is_anchor boolean")
    boxes = _boxes(weighed.drop("is_anchor"), ROW_BOX, "negatives-rows")
    found = boxes.agg(F.count("*").alias("n"), F.max("top").alias("top")).first()
    cells = max(1, found["n"] // 8)  # several boxes a cell: asks are dealt to cells
    anchors = stage(weighed.where("is_anchor").drop("is_anchor").withColumn("ask", F.monotonically_increasing_id()), "negatives-anchors")

    every = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(-_MOST - 1).alias("floor"), F.lit(_MOST).alias("high")))
    asks = anchors.withColumn("cap", F.sqrt("power") * F.lit(float(found["top"] or 0.0) ** 0.5)).withColumn("windows", every)
    near = stage(_search(asks, boxes, cells, positives, True, POSITIVE_ROUNDS).select(
        "ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    # whole-number ends of the window; a product of 20 digits and a share needs a decimal
    spans = near.where("positive_score >= 0").select(
        "ask", F.struct(F.col("positive_score").alias("key"), F.expr(f"cast((cast(positive_score as decimal(20,0)) * {window[0]} + 99) div 100 as bigint)").alias("floor"),
                        F.expr(f"cast((cast(positive_score as decimal(20,0)) * {window[1]}) div 100 as bigint)").alias("high")).alias("w"))
    asks = (anchors.join(spans.groupBy("ask").agg(F.collect_set("w").alias("windows")), "ask")
            .withColumn("cap", F.array_max(F.transform("windows", lambda w: w["high"].cast("double")))).select(*anchors.columns, "cap", "windows"))
    far = _search(asks, boxes, cells, negatives, False, NEGATIVE_ROUNDS)
    ends = near.join(anchors.select("ask", F.col("vec_id").alias("anchor_id")), "ask").withColumn("key", F.col("positive_score"))
    out = stage(ends.join(far, ["ask", "key"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                                       "positive_score", F.col("score").alias("negative_score")), "negatives-result")
    discard(boxes, anchors, near)
    return out
