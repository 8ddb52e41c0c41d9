"""Exact top-k inner-product search by term-at-a-time accumulation.

Vectors are rows over terms (their dimensions) with integer weights.  They are
gathered into blocks that hold one posting list per term.  A block of queries
meets a block of candidates once: term by term, the queries that have the term
scatter its weighted postings into a dense score array; a partition selection
keeps k candidates per query and block, and these are merged per query.

A task takes some query blocks and some candidate blocks, which it reads from
the written tables itself (a Cartesian product of their partitions): neither
side is copied for the other, broadcast or collected.  It holds one pair of
blocks at a time, and k candidates for each query of the block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import BLOCK_ROWS, stage

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
TASK_BLOCKS = 16  # blocks of either side that a task takes, if there are tasks enough
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_BLOCK = "block long, ids binary, n_terms int, postings binary"


def _matrix(batch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and an (n, terms) float matrix of floor(scale * x) of the valid rows; shorter vectors end in zeros."""
    own, column = batch.column(0), batch.column(1)
    flat = column.flatten().cast(pa.float64())
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = flat.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)  # null becomes nan
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(sizes)) > 0
    good = ~bad & own.is_valid().to_numpy(zero_copy_only=False) & column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[row, place] = np.floor(scale * np.where(np.isfinite(values), values, 0.0))
    return own.filter(pa.array(good)).cast(pa.int64()).to_numpy(zero_copy_only=False), out[good]


def _blocks(vectors: DataFrame, rows: int, scale: float, name: str) -> DataFrame:
    """Blocks of posting lists, one list per term, ids ascending within a block."""

    def cut(batches):
        press, number = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId() << 32
        held, held_ids, n = [], [], 0

        def out():
            terms = max(m.shape[1] for m in held)
            own = np.concatenate(held_ids)
            order = np.argsort(own, kind="stable")
            whole = np.vstack([np.pad(m, ((0, 0), (0, terms - m.shape[1]))) for m in held])[order]
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([own[order].tobytes()], pa.binary()),
                                    pa.array([terms], pa.int32()),
                                    pa.array([press(np.ascontiguousarray(whole.T).tobytes())], pa.binary())],
                                   names=["block", "ids", "n_terms", "postings"])

        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                own, m = _matrix(batch.slice(first, rows), scale)
                if n and n + len(own) > rows:
                    yield out()
                    held, held_ids, n, number = [], [], 0, number + 1
                if len(own):
                    held.append(m), held_ids.append(own)
                    n += len(own)
        if n:
            yield out()

    return stage(vectors.mapInArrow(cut, _BLOCK), name)


def _opened(own: bytes, terms: int, postings: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(own, np.int64)
    raw = zstandard.ZstdDecompressor().decompress(postings, max_output_size=8 * terms * len(ids) + 1) if terms else b""
    return ids, np.frombuffer(raw, np.float64).reshape(terms, len(ids))


def accumulate(queries: np.ndarray, postings: np.ndarray) -> np.ndarray:
    """Scores of (terms, q) queries against (terms, n) postings, term by term."""
    terms = min(len(queries), len(postings))
    scores = np.zeros((queries.shape[1], postings.shape[1]), queries.dtype)
    weighted = np.empty_like(scores)
    for t in range(terms):
        has = np.flatnonzero(queries[t])
        if 2 * len(has) > len(scores):  # the others add zeros, which costs less than to pick rows
            np.multiply(queries[t][:, None], postings[t], out=weighted)
            scores += weighted
        elif len(has):
            scores[has] += queries[t][has, None] * postings[t]
    return scores


def select(q_ids: np.ndarray, queries: np.ndarray, c_ids: np.ndarray, postings: np.ndarray, k: int, best: tuple | None = None):
    """(query position, candidate id, score) of the k best candidates of each query, ties to the smaller id.

    ``best`` is what earlier candidates gave for the same queries; it is
    merged.  Exact also for huge components: those take arbitrary-precision
    integers, and scores beyond 64 bits are clamped.
    """
    terms = max(1, min(len(queries), len(postings)))
    most = np.abs(queries).max(initial=0) * np.abs(postings).max(initial=0) * terms
    small = most * 2 * CANDIDATE_BLOCK < 1 << 62
    if small:
        kind = np.int32 if max(most, np.abs(queries).max(initial=0), np.abs(postings).max(initial=0)) < 1 << 31 else np.int64
        queries, postings = queries.astype(kind), postings.astype(kind)
    else:
        queries, postings = (np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (queries, postings))
    at, found, score = best or (np.zeros(0, np.int64),) * 3
    least = _kth(at, score, len(q_ids), k)
    for first in range(0, len(c_ids), 1024):
        own = c_ids[first:first + 1024]
        scores = accumulate(queries, postings[:, first:first + 1024])
        same = q_ids[:, None] == own
        hopeful = scores >= least[:, None] if small else None
        if small and np.count_nonzero(hopeful) <= 8 * (k + 1) * len(q_ids):
            row, col = np.nonzero(hopeful & ~same)
        else:
            order = scores.astype(np.int64 if small else object) * 1024 + np.arange(len(own) - 1, -1, -1).astype(np.int64 if small else object)
            order[same] = -(1 << 62) if small else -(1 << 4000)
            if len(own) > k and small:
                pick = np.argpartition(order, len(own) - k, axis=1)[:, -k:]
            else:
                pick = np.argsort(order, axis=1)[:, -k:]
            row, col = np.repeat(np.arange(len(q_ids)), pick.shape[1]), pick.reshape(-1)
            keep = ~same[row, col]
            row, col = row[keep], col[keep]
        if not len(row):
            continue
        new = scores[row, col].astype(np.int64) if small else np.array([min(_MOST, max(_LEAST, x)) for x in scores[row, col]], np.int64)
        at, found, score = np.concatenate([at, row]), np.concatenate([found, own[col]]), np.concatenate([score, new])
        order = np.lexsort((found, ~score, at))  # ~score falls as score rises and cannot overflow
        at, found, score = at[order], found[order], score[order]
        keep = np.arange(len(at)) - np.searchsorted(at, at) < k
        at, found, score = at[keep], found[keep], score[keep]
        least = _kth(at, score, len(q_ids), k)
    return at, found, score


def _kth(at: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th best score of each query, the least number if it has fewer; ``at`` ascends, scores descend."""
    out = np.full(n, _LEAST)
    if k > 0:
        last = np.flatnonzero(np.arange(len(at)) - np.searchsorted(at, at) == k - 1)
        out[at[last]] = score[last]
    return out


def _in_tasks(blocks: DataFrame) -> DataFrame:
    """The blocks in so many partitions that neither tasks nor what each does grow without bound."""
    least = math.isqrt(8 * blocks.sparkSession.sparkContext.defaultParallelism) + 1
    return blocks.coalesce(max(least, -(-blocks.count() // TASK_BLOCKS)))


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 5, scale: float = 256.0,
          vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best candidates of each query row.

    Weights are floor(scale * x), x as double; the score is the integer inner
    product.  Candidates are all rows but those with the query's own id.
    Ties go to the smaller vec_id.  Rows without id, null vectors and vectors
    with null or non-finite components take no part; a shorter vector
    counts as ending in zeros; an empty one scores 0.  Repeated query rows
    each get their list, repeated candidates each count.  Empty table: empty
    result.  Other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    ask = vectors.where(is_query).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    candidates = _blocks(rows, CANDIDATE_BLOCK, scale, "topk-candidates")
    queries = _blocks(ask, QUERY_BLOCK, scale, "topk-queries")
    asked = queries.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("n_terms").alias("q_terms"),
                           F.col("postings").alias("q_postings"))
    # every query block meets every candidate block; the hint keeps Spark from a broadcast, which grows with both sides
    pairs = _in_tasks(asked).hint("shuffle_replicate_nl").crossJoin(_in_tasks(candidates.drop("block")))

    def meet(batches):
        block, best = None, None

        def out():
            at, found, score = best
            return pa.record_batch([pa.array(np.full(len(at), block, np.int64)), pa.array(at.astype(np.int64)),
                                    pa.array(q_ids[at]), pa.array(found), pa.array(score)],
                                   names=["q_block", "at", "query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["q_block"] != block:  # a query block meets all candidate blocks of the task in turn
                    if best:
                        yield out()
                    block, best = row["q_block"], None
                    q_ids, asked = _opened(row["q_ids"], row["q_terms"], row["q_postings"])
                c_ids, postings = _opened(row["ids"], row["n_terms"], row["postings"])
                best = select(q_ids, asked, c_ids, postings, k, best)
        if best:
            yield out()

    best = stage(pairs.mapInArrow(meet, "q_block long, at long, query_id long, vec_id long, score long"),
                 "topk-best", BLOCK_ROWS)
    order = Window.partitionBy("q_block", "at").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
