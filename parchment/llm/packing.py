"""Best-fit packing of token sequences, planned on the histogram of lengths.

Best fit never looks at a document, only at lengths: pieces of one length are
interchangeable.  So the plan is made from the counts per length (at most
``capacity`` numbers, whatever the corpus), bins with equal room are handled
as one range of sequence ids, and every placement is one range of ranks within
a length.  Documents then take their planned slot by (length, rank).
"""

from __future__ import annotations

import bisect
import functools
import string
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parchment.llm.common import id_array, ids, stage, utf8

CAPACITY = 2048
_CACHE_WORDS = 300_000
_MARKS = ".,;:!?%&)"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])


class _Recent(dict):
    """key -> ``make(key)``, filled on demand and bounded: two generations of ``_CACHE_WORDS`` keys.

    When the young generation is full it becomes the old one; a key found in
    the old one is young again, so frequent keys are never made twice.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= _CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class _Words(_Recent):
    """Blank-separated word -> its ids as little-endian uint32.

    The tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids one after another.  Most words are plain letters
    with marks after them: where the tokenizer is seen to keep a run of such
    letters as one part and to start another at a mark (``_plain_letters``),
    the letters go to its model at once and the marks are encoded apart.  All
    other words are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        model, letters = tokenizer.model, _plain_letters(tokenizer)
        part = _Recent(lambda piece: array("I", [t.id for t in model.tokenize(piece)]).tobytes())
        other = _Recent(lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
        table = str.maketrans(letters)

        def ids_of(word: bytes) -> bytes:
            text = word.decode()
            core = text.rstrip(_MARKS)
            if not core or not letters.keys() >= set(core):
                return other[text]
            coded = part[core if core.isascii() else core.translate(table)]
            return coded if len(core) == len(text) else coded + other[text[len(core):]]

        super().__init__(ids_of)


def _plain_letters(tokenizer) -> dict[str, str]:
    """Lower-case letters -> how the model sees them; empty unless runs of them are one part that ends at a mark."""
    normalizer, splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
    if normalizer is None or splitter is None:
        return {}

    def parts(text: str) -> list[str]:
        return [piece for piece, _ in splitter.pre_tokenize_str(normalizer.normalize_str(text))]

    found = [c for c in map(chr, range(0x250)) if c.isalpha() and c.islower() and normalizer.normalize_str(c) == c]
    seen = {c: parts(c) for c in found}
    letters = {c: p[0] for c, p in seen.items() if len(p) == 1}
    run, whole = "".join(letters), "".join(letters.values())
    ascii_kept = all(letters.get(c) == c for c in string.ascii_lowercase)
    if not ascii_kept or parts(run) != [whole] or any(parts(run + m) != [whole, *parts(m)] for m in _MARKS):
        return {}
    return letters


@functools.lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def tokens(text: bytes, words: _Words) -> bytes:
    """The ids of ``text`` as little-endian uint32."""
    if b"<|" not in text:  # special tokens are found before the tokenizer lowers case
        text = text.lower()
    return b"".join(map(words.__getitem__, text.split()))


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of at most ``capacity`` ids with their rank (``nth``) among a task's pieces of that length."""

    def cut(batches):
        words, task, seen = _words(tokenizer), TaskContext.get().partitionId(), {}
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            raw, at = utf8(batch.column(1))
            whole = raw.tobytes()
            out = []
            for i in range(batch.num_rows):
                coded = tokens(whole[at[i]:at[i + 1]], words) + end
                total = len(coded) // 4
                for p, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    out.append((i, p, start, length, zlib.crc32(coded[4 * start:4 * (start + length)]), nth))
            row, p, start, length, crc, nth = np.array(out, np.int64).reshape(-1, 6).T
            yield pa.record_batch([
                id_array(ids(batch.column(0))[row]), pa.array(p.astype(np.int32)), pa.array(start), pa.array(length),
                pa.array(crc), pa.array(np.full(len(row), task, np.int32)), pa.array(nth)], schema=_PIECES)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, ranks, first sequence, per sequence, offset).

    ``room`` maps the room left to ranges of sequence ids; the fullest bins
    that still fit are filled first, new bins are opened for the rest.
    """
    out, next_id = [], 0
    room: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []  # the rooms there are, ascending

    def put(left: int, first: int, n: int) -> None:
        if left > 0 and n > 0:
            if left not in room:
                room[left] = []
                bisect.insort(order, left)
            room[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            i = bisect.bisect_left(order, length)
            if i < len(order):
                left = order[i]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], order[i]
            else:
                left, first, n = capacity, next_id, -(-todo // (capacity // length))
                next_id += n
            each = left // length
            full, over = divmod(min(todo, n * each), each)
            if full:
                out.append((length, rank, full * each, first, each, capacity - left))
                put(left - each * length, first, full)
            if over:
                out.append((length, rank + full * each, over, first + full, over, capacity - left))
                put(left - over * length, first + full, 1)
            put(left, first + full + (over > 0), n - full - (over > 0))
            rank += full * each + over
            todo -= full * each + over
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A document is the ids of its whole text and ``end_id``.  Only documents
    above ``capacity`` are cut; their last piece may be shorter.  Null and
    empty texts are one piece with ``end_id`` alone.  Null doc_ids stay null,
    repeated rows are packed each.  Empty table: empty result.  Other columns
    of ``docs`` are not read.  The plan broadcast has at most a few entries
    per length (``capacity`` bounds it, not the corpus).
    """
    spark: SparkSession = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, end_id, capacity, doc_id, text), "pack-pieces")
    sizes = cut.groupBy("task", "length").agg((F.max("nth") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity) or [], "s_length long, first long, n long, sequence long, each long, base long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("task").alias("t_task"), F.col("length").alias("t_length"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(starts, (F.col("task") == F.col("t_task")) & (F.col("length") == F.col("t_length"))).withColumn(
        "rank", F.col("nth") + F.col("before"))
    within = F.col("rank") - F.col("first")
    return ranked.join(
        F.broadcast(slots), (F.col("length") == F.col("s_length")) & (within >= 0) & (within < F.col("n"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"),
        (F.col("base") + (within % F.col("each")) * F.col("length")).alias("offset"))
