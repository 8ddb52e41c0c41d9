"""Language identification with a blended-spectrum string kernel.

k(x, y) counts the byte n-grams (n = 1, 2, 3, lower-cased UTF-8) present in
both texts, over sqrt(k(x, x) k(y, y)); 2- and 3-grams are told apart by a
hash to ``_BITS`` bits, so n-grams that share a value count as one.  Kernel ridge regression, one class
against the rest, is solved in the span of Nystroem landmarks.  The kernel is
linear in a text's presence vector, so landmarks and coefficients fold into
one matrix (n-gram buckets x classes): a batch of texts is scored by one
product of its sparse presence matrix with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import settings, stage, utf8

#: The model is fitted on at most this many labelled rows, spread evenly over the languages.
FIT_ROWS = 4096
LANDMARKS = 384
RIDGE = 1e-3
UNKNOWN = "und"
# Up to so many places Spark cuts a window's rows in each map task, before it shuffles them.
_CUT_EARLY = "spark.sql.optimizer.windowGroupLimitThreshold"
_BITS = (8, 13, 14)  # buckets of 1-, 2- and 3-grams, as powers of two
_BUCKETS = sum(1 << b for b in _BITS)
_STEP = 1 << 21


def presence(column) -> list[np.ndarray]:
    """The n-gram buckets that occur in each text of an Arrow string column, ascending."""
    raw, at = utf8(pc.utf8_lower(column))
    out: list[np.ndarray] = []
    seen = np.zeros(_BUCKETS, bool)
    first, n = 0, len(at) - 1
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(at, at[first] + _STEP, "right")) - 1))
        b = raw[at[first]:at[last]].astype(np.uint32)
        grams, base, code = [], 0, np.zeros(len(b), np.uint32)
        for k, bits in enumerate(_BITS):
            code = (code[:-1] if k else code) * np.uint32(257) + b[k:] if len(b) >= k else code[:0]
            bucket = code if bits == 8 else (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
            grams.append(bucket.astype(np.int32) + base)
            base += 1 << bits
        for i in range(first, last):
            lo, hi = at[i] - at[first], at[i + 1] - at[first]
            for k, g in enumerate(grams):
                seen[g[lo:max(lo, hi - k)]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            out.append(found)
        first = last
    return out


@dataclass(frozen=True)
class Model:
    """Languages and the folded coefficients, (buckets, languages)."""

    languages: tuple[str, ...]
    folded: np.ndarray

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        """One row of class outputs per text: presence matrix times folded coefficients, over the kernel norm."""
        sizes = np.array([len(x) for x in found])
        rows = self.folded[np.concatenate(found)] if sizes.sum() else np.zeros((0, len(self.languages)))
        total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, 0)])
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        return (total[cuts[1:]] - total[cuts[:-1]]) / np.sqrt(np.maximum(sizes, 1))[:, None]


def _dense(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), _BUCKETS), np.float32)
    for i, x in enumerate(rows):
        out[i, x] = 1 / np.sqrt(max(1, len(x)))
    return out


def solve(rows: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem kernel ridge regression; classes weigh the same, landmarks are the first rows of each class in turn."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.zeros((_BUCKETS, 0)))
    y = np.array([languages.index(x) for x in labels])
    place = np.empty(len(y), np.int64)
    for k in range(len(languages)):
        own = np.flatnonzero(y == k)
        place[own] = np.arange(len(own))
    marks = _dense([rows[i] for i in np.lexsort((y, place))[:landmarks]])
    m = len(marks)
    gram, target = np.zeros((m, m)), np.zeros((m, len(languages)))
    weight = 1.0 / np.bincount(y, minlength=len(languages))[y]
    weight /= weight.mean()
    for i in range(0, len(rows), 256):
        near = (_dense(rows[i:i + 256]) @ marks.T).astype(float)
        here = weight[i:i + 256, None]
        gram += near.T @ (near * here)
        target += near.T @ (np.where(y[i:i + 256, None] == np.arange(len(languages)), 1.0, -1.0) * here)
    inner = (marks @ marks.T).astype(float)
    alpha = np.linalg.solve(gram + ridge * len(rows) * inner + 1e-8 * len(rows) * np.eye(m), target)
    return Model(languages, marks.T.astype(float) @ alpha)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from rows with a language whose crc32(doc_id as text) mod 5 is not 0.

    ``fit_rows`` ids are chosen by their hash, as many of each language
    (a bounded list, broadcast to find their texts); where ids repeat, the
    first 2 * ``fit_rows`` texts by (id, language, n-grams) are used.  Rows without id,
    text or language take no part.
    """
    known = docs.select(F.col(doc_id).cast("long").alias("k_id"), F.col(lang).alias("k_lang")).where(
        "k_id is not null and k_lang is not null").where(F.crc32(F.col("k_id").cast("string").cast("binary")) % 5 != 0)
    n_languages = known.agg(F.count_distinct("k_lang")).first()[0]
    order = Window.partitionBy("k_lang").orderBy(F.xxhash64("k_id"), "k_id")
    places = max(1, fit_rows // max(1, n_languages))
    with settings(docs.sparkSession, {_CUT_EARLY: str(max(1000, places))}):
        chosen = stage(known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places)
                       .drop("place").distinct(), "language-rows")

    def bits(batches):
        for batch in batches:
            packed = []
            for x in presence(batch.column(0)):
                seen = np.zeros(_BUCKETS, bool)
                seen[x] = True
                packed.append(np.packbits(seen).tobytes())
            yield pa.record_batch([pa.array(packed, pa.binary()), batch.column(1), batch.column(2)], names=["bits", "lang", "id"])

    texts = docs.select(F.col(doc_id).cast("long").alias("d_id"), F.col(text).alias("d_text"), F.col(lang).alias("d_lang")).where("d_text is not null")
    rows = texts.join(F.broadcast(chosen), (F.col("d_id") == F.col("k_id")) & (F.col("d_lang") == F.col("k_lang"))).select(
        "d_text", "k_lang", "d_id").mapInArrow(bits, "bits binary, lang string, id long")
    got = sorted(rows.orderBy("id", "lang", "bits").limit(2 * fit_rows).collect(), key=lambda r: (r["id"], r["lang"], bytes(r["bits"])))
    found = [np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=_BUCKETS)) for r in got]
    return solve(found, [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score in [0, 1]: one row per row of ``docs``.

    Only the whole text is used.  Null texts and texts without a letter
    (``\\p{L}``) are ``und`` with score 0, as is everything if no language was
    learned.  A null doc_id is not held out.  Repeated rows are predicted
    each; empty table: empty result; other columns are not read.
    """

    def apply(batches):
        for batch in batches:
            n = batch.num_rows
            lettered = batch.column(3).to_numpy(zero_copy_only=False)
            best, sure = np.zeros(n, int), np.zeros(n)
            if model.languages:
                out = 4 * model.score(presence(batch.column(1)))
                out = np.exp(out - out.max(1, keepdims=True))
                best, sure = out.argmax(1), out.max(1) / out.sum(1)
            names = [model.languages[b] if ok and model.languages else UNKNOWN for b, ok in zip(best, lettered)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(names, pa.string()),
                                   pa.array(np.where(lettered, sure, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    own = F.col(doc_id).cast("long")
    held = F.coalesce(F.crc32(own.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(own.alias("doc_id"), F.col(text), held.alias("held_out"), letter.alias("letter")).mapInArrow(
        apply, "doc_id long, held_out boolean, lang_pred string, score double")
