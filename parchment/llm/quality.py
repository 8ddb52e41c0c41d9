"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics are shares of character classes and word and line shapes of the
whole text, on a log scale.  Each class (label 0 and 1) has a mean and a
covariance shrunk towards its diagonal and a multiple of the identity; the
score is the log-density difference of two Mahalanobis forms, computed from
Cholesky factors made once, mapped to (0, 1).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import stage, utf8

#: The model is fitted on at most this many labelled rows (those with the smallest hashes).
FIT_ROWS = 20_000
THRESHOLD = 0.3
SHRINKAGE = 0.1
#: The covariance common to both classes counts as so many rows of each class.
PRIOR_ROWS = 30
_STEP = 1 << 21  # bytes of text whose statistics are computed at once

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_BLANK = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_WIDE = _BYTE >= 128
_STOPS = np.isin(_BYTE, list(b".,;:?!'\"()-"))
_MARKS = ~(_UPPER | _LOWER | _DIGIT | _BLANK | _WIDE | _STOPS)
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _BLANK, _WIDE, _STOPS, _MARKS, _BYTE == 10, _BYTE == 33], 1).astype(float)
N_STATISTICS = 15


def _some(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, sizes = len(at) - 1, np.diff(at)
    of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(of * 256 + raw, minlength=n * 256).reshape(n, 256).astype(float)
    total = sizes + 1.0
    upper, lower, digit, blank, wide, stops, marks, lines, shouts = (counts @ _CLASSES).T
    solid = ~_BLANK[raw]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | (of[1:] != of[:-1])
    words = np.bincount(of[starts], minlength=n) + 1.0
    capital = np.bincount(of[starts], _UPPER[raw[starts]], minlength=n)
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | (of[1:] != of[:-1])
    odd_end = np.bincount(of[ends], _MARKS[raw[ends]], minlength=n)
    repeats = np.bincount(of[_repeated(raw, np.flatnonzero(starts), np.flatnonzero(ends), of)], minlength=n)
    share = counts / total[:, None]
    entropy = -(share * np.log(share + 1e-12)).sum(1)
    letters = upper + lower + wide

    def rate(part, whole):
        return np.log((part + 0.5) / (whole + 1.0))

    return np.stack([np.log(total), rate(letters, total), rate(upper, letters), rate(digit, total), rate(blank, total),
                     rate(wide, total), rate(stops, total), rate(marks, total), rate(lines, words), rate(shouts, words),
                     np.log((letters + 1) / words), rate(capital, words), rate(odd_end, words),
                     rate(repeats, words), entropy], 1)


def _repeated(raw: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Starts of words that repeat the word before, compared eight bytes at a time."""
    if not len(first):
        return first
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    size = last - first + 1
    word = np.ndarray(len(raw), "<u8", buffer=padded, strides=(1,))
    same = 1 + np.flatnonzero((size[1:] == size[:-1]) & (of[first[1:]] == of[first[:-1]]))
    done, open_, at = [], same, 0
    while len(open_):
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(size[open_] - at, 8)).astype(np.uint64))
        open_ = open_[(word[first[open_] + at] ^ word[first[open_ - 1] + at]) & mask == 0]
        at += 8
        whole = size[open_] <= at
        done.append(open_[whole])
        open_ = open_[~whole]
    return first[np.sort(np.concatenate([same[:0], *done]))]


def statistics(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """An (n, ``N_STATISTICS``) matrix for n texts; an empty text has the statistics of zero counts."""
    out, first, n = [np.zeros((0, N_STATISTICS))], 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + _STEP, "right")) - 1)
        last = min(last, n)
        out.append(_some(raw[at[first]:at[last]], at[first:last + 1] - at[first]))
        first = last
    return np.concatenate(out)


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors of the shrunk covariances, and constants of the log densities."""

    means: np.ndarray
    whiten: np.ndarray
    constants: np.ndarray
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        log = [c - 0.5 * (((x - m) @ w) ** 2).sum(1) for m, w, c in zip(self.means, self.whiten, self.constants)]
        return 1 / (1 + np.exp(-np.clip((log[1] - log[0]) / self.scale, -50, 50)))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant:
    """From (n, sum, sum of outer products) per class; a class without rows takes the other's shape (score 0.5).

    A class covariance is drawn towards the two classes' common one, the more
    the fewer rows the class has, and then towards its diagonal.
    """
    d = N_STATISTICS
    n_all = sum(m[0] for m in moments.values())
    pooled = (n_all, sum(m[1] for m in moments.values()), sum(m[2] for m in moments.values())) if n_all else (
        1.0, np.zeros(d), np.eye(d))
    common = sum((m[2] - np.outer(m[1], m[1]) / m[0] for m in moments.values()), np.zeros((d, d))) / n_all if n_all else np.eye(d)
    means, whiten, constants = [], [], []
    for k in (0, 1):
        n, s, ss = moments.get(k, (0.0, pooled[1], pooled[2]))
        weight = n if n else pooled[0]
        mean = s / weight
        cov = (ss - np.outer(mean, s) + PRIOR_ROWS * common) / (weight + PRIOR_ROWS)
        level = max(np.trace(cov) / d, 1e-6)
        cov = (1 - 2 * shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + shrinkage * level * np.eye(d)
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        whiten.append(np.linalg.inv(factor).T)
        both = all(k in moments and moments[k][0] for k in (0, 1))
        constants.append(-np.log(np.diag(factor)).sum() + (math.log(n / n_all) if both else 0.0))
    # The statistics are correlated beyond what two Gaussians express: temper the difference by the dimension.
    return Discriminant(np.stack(means), np.stack(whiten), np.array(constants), math.sqrt(d))


def _moment_rows(x: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """The sums of x and of its outer products by class, one row per entry: they add up in a Spark aggregation."""
    d = N_STATISTICS
    k, i, j, v = [], [], [], []
    for c in (0, 1):
        own = np.hstack([np.ones((int((label == c).sum()), 1)), x[label == c]])
        full = own.T @ own
        a, b = np.triu_indices(d + 1)
        k.append(np.full(len(a), c)), i.append(a), j.append(b), v.append(full[a, b])
    cols = [np.concatenate(z) for z in (k, i, j)]
    return pa.record_batch([*(pa.array(z, pa.int32()) for z in cols), pa.array(np.concatenate(v))],
                           names=["label", "i", "j", "v"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label_id: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS) -> Discriminant:
    """Fit on the labelled rows (``label`` 0 or 1) whose crc32(doc_id as text) mod 5 is not 0.

    Of those, the ``fit_rows`` with the smallest hash of the id are used; the
    id list is therefore bounded and may be broadcast.  Rows without an id or
    with another label take no part.
    """
    chosen = stage(
        labels.select(F.col(label_id).cast("long").alias("l_id"), F.col(label).cast("int").alias("label"))
        .where("l_id is not null and label in (0, 1)").where(F.crc32(F.col("l_id").cast("string").cast("binary")) % 5 != 0)
        .distinct().orderBy(F.xxhash64("l_id"), "l_id", "label").limit(fit_rows), "quality-rows")

    def sums(batches):
        for batch in batches:
            raw, at = utf8(batch.column(0))
            yield _moment_rows(statistics(raw, at), batch.column(1).to_numpy(zero_copy_only=False))

    rows = (docs.select(F.col(doc_id).cast("long").alias("d_id"), F.col(text).alias("d_text"))
            .join(F.broadcast(chosen), F.col("d_id") == F.col("l_id")).select("d_text", "label")
            .mapInArrow(sums, "label int, i int, j int, v double").groupBy("label", "i", "j").agg(F.sum("v").alias("v")))
    full = np.zeros((2, N_STATISTICS + 1, N_STATISTICS + 1))
    for r in rows.collect():  # 2 x 136 numbers, whatever the corpus
        full[r["label"], r["i"], r["j"]] = full[r["label"], r["j"], r["i"]] = r["v"]
    return discriminant({k: (m[0, 0], m[0, 1:], m[1:, 1:]) for k, m in enumerate(full) if m[0, 0]})


def score(docs: DataFrame, model: Discriminant, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score in (0, 1), predicted (1 from ``threshold`` on): one row per row of ``docs``.

    Only the text is used; null is an empty text and is scored as such.  A
    null doc_id is held out of nothing (held_out false).  Repeated rows are
    scored each, an empty table gives an empty result, other columns of
    ``docs`` are not read.
    """

    def apply(batches):
        for batch in batches:
            raw, at = utf8(batch.column(1))
            p = model.score(statistics(raw, at))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(p),
                                   pa.array((p >= threshold).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    own = F.col(doc_id).cast("long")
    held = F.coalesce(F.crc32(own.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return docs.select(own.alias("doc_id"), F.col(text), held.alias("held_out")).mapInArrow(
        apply, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Discriminant, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all columns (a filter in one pass, no shuffle)."""
    column = docs.columns.index(text)

    def apply(batches):
        for batch in batches:
            raw, at = utf8(batch.column(column))
            yield batch.filter(pa.array(model.score(statistics(raw, at)) >= threshold))

    return docs.mapInArrow(apply, docs.schema)
