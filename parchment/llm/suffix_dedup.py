"""Repeated-substring removal by blockwise suffix sorting with a difference cover.

Only the order of suffixes up to ``width`` bytes matters, so a suffix's sort
key is the fingerprint of its first ``width`` bytes: any total order puts equal
strings side by side, and this one splits suffixes into even buckets (the
owners of the fingerprint exchange) without looking for splitters.  Each
bucket is sorted on its own, in one task's bounded memory.

The difference cover: positions p of a document with p mod 31 in ``COVER``
are samples.  For any two positions i, j there is a shift d < 31 that makes
both i + d and j + d samples, so two equal ``width``-byte strings hold equal
strings of ``width`` - 30 bytes at samples they share.

1. Cover ranks: the samples' strings (of width - 30 bytes) are sorted first;
   a sample that no other document shares has a rank of its own.
2. A suffix whose samples within 31 bytes all have ranks of their own ties
   with no suffix of another document: the ranks resolve it and it enters no
   bucket.  The others are sorted, bucket by bucket, with the smallest doc_id
   of their block; a bucket answers where a smaller doc_id has the string.
3. Each document marks the bytes of the answered suffixes and is cut.

A document whose whole text a smaller doc_id has ties in every suffix with it;
such copies are told by the SHA-256 of the texts first and enter no bucket.
A block sends a string once, however often it repeats, so a passage that a
third of all rows share is one entry per block.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm import blocks, exchange
from parchment.llm.common import BLOCK_ROWS, discard, fingerprints, id_array, stage

PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # a perfect difference set modulo 31
COPY = 2  # kind of the rows that tell a block which of its documents repeat a smaller doc_id's whole text
_IS_SAMPLE = np.isin(np.arange(PERIOD), COVER)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sorting order, the start of each group in it, and each entry's group."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[starts], order, starts, inverse


def _reduce(how, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return how.reduceat(values, starts) if len(starts) else values[:0]


class _Block:
    """The suffixes of a block: samples, their sorted strings, and what the answers say of them."""

    def __init__(self, block, replies: pa.Table, width: int, key_width: int):
        self.number, self.own, self.raw, self.at = blocks.opened(block)
        self.width, self.short = width, width - PERIOD + 1
        self.copies = replies["owner"].filter(pc.equal(replies["kind"], COPY)).to_numpy()
        sizes = np.diff(self.at)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pattern = np.resize(_IS_SAMPLE, int(sizes.max(initial=0)))
        sample, self.reach = np.zeros(len(self.raw), bool), np.zeros(len(self.raw), bool)
        copy = np.zeros(len(sizes), bool)
        copy[self.copies] = True
        for lo, hi in zip(self.at[:-1][~copy], self.at[1:][~copy]):
            if hi - lo >= width:
                sample[lo:hi - self.short + 1] = pattern[:hi - self.short + 1 - lo]
                self.reach[lo:hi - width + 1] = True
        self.samples = np.flatnonzero(sample)
        self.keys, self.order, self.starts, self.inverse = _grouped(
            fingerprints(self.raw, self.samples, self.short) >> np.uint64(64 - key_width))

    def tied(self, elsewhere: np.ndarray) -> np.ndarray:
        """Positions of the suffixes that may tie with one of another document."""
        doc = self.doc[self.samples[self.order]]
        several = (elsewhere > 0) | (_reduce(np.minimum, doc, self.starts) != _reduce(np.maximum, doc, self.starts))
        marks = np.zeros(len(self.raw) + PERIOD + 1, np.int32)
        marks[self.samples[several[self.inverse]] + 1] = 1
        count = np.cumsum(marks, dtype=np.int32)
        n = len(self.raw)
        return np.flatnonzero(self.reach & (count[PERIOD:n + PERIOD] > count[:n]))

    def strings(self, positions: np.ndarray):
        """Sorted distinct keys of the suffixes, each position's place among them, and the smallest doc_id here."""
        keys, order, starts, inverse = _grouped(fingerprints(self.raw, positions, self.width))
        return keys, inverse, _reduce(np.minimum, self.own[self.doc[positions[order]]], starts)


def _hashes(raw: np.ndarray, at: np.ndarray) -> bytes:
    whole = memoryview(np.ascontiguousarray(raw))
    return b"".join(hashlib.sha256(whole[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist()))


def _listed(batches):
    for block in blocks.each(batches):
        row = block.to_pylist()[0]
        own = np.frombuffer(row["ids"], np.int64)
        yield pa.record_batch([
            pa.array(np.full(len(own), row["block"])), pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own),
            pa.array([row["side"][i:i + 32] for i in range(0, 32 * len(own), 32)], pa.binary())],
            names=["block", "place", "own", "sha"])


def dedup_substrings(docs: DataFrame, width: int = 50, with_text: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if ``with_text``, spans and kept (bytes): one row per row of ``docs``.

    Every byte covered by a ``width``-byte string (at least 39) that also
    starts in a document with a smaller doc_id goes; overlaps count, and
    strings are judged on the input.  Texts are UTF-8 bytes; null is empty,
    matches never cross documents.  Shorter texts lose nothing.  A null
    doc_id is larger than any other and not smaller than another null.  Rows
    with equal doc_ids do not remove each other's bytes.  Empty table: empty
    result.  Other columns of ``docs`` are not read.
    """
    table = blocks.build(docs, "suffix-blocks", _hashes, doc_id, text)
    n = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).cast("long")).first()[0]
    sample_bits = exchange.owner_bits(n * len(COVER) // PERIOD)
    key_width = min(64, max(24, math.ceil(math.log2(max(2, n))) + 8))
    bits = exchange.owner_bits(n // 8)

    texts = stage(table.select("block", "ids", "side").mapInArrow(_listed, "block long, place int, own long, sha binary"),
                  "suffix-texts", BLOCK_ROWS)
    # Written, so that the join below deals both sides itself and can split a large group.
    first = stage(texts.groupBy("sha").agg(F.min("own").alias("first")).withColumnRenamed("sha", "f_sha"), "suffix-firsts")
    copies = stage(texts.join(first, (F.col("sha") == F.col("f_sha")) & (F.col("own") > F.col("first"))).select(
        "block", F.lit(COPY).alias("kind"), F.col("place").alias("owner"), F.lit(None).cast("binary").alias("codes")), "suffix-copies")

    def told(replies: DataFrame, do, schema: str) -> DataFrame:
        return table.select("block", "ids", "sizes", "text").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(do, schema)

    def ask_samples(block: pa.Table, replies: pa.Table) -> pa.Table:
        b = _Block(block, replies, width, key_width)
        return pa.Table.from_batches([exchange.requests(b.number, b.keys, sample_bits, key_width)])

    ranks = stage(exchange.shared(told(copies, ask_samples, exchange.REQUEST), sample_bits, key_width), "suffix-ranks", BLOCK_ROWS)

    def ask_suffixes(block: pa.Table, replies: pa.Table) -> pa.Table:
        b = _Block(block, replies, width, key_width)
        elsewhere = exchange.answers(replies, 0, b.keys, sample_bits, key_width)
        keys, _, least = b.strings(b.tied(elsewhere))
        return pa.Table.from_batches([exchange.requests(b.number, keys, bits, extra=least)])

    asked = told(ranks.unionByName(copies), ask_suffixes, exchange.REQUEST)
    below = stage(exchange.undercut(asked, bits, kind=1), "suffix-answers", BLOCK_ROWS)

    def cut(block: pa.Table, replies: pa.Table) -> pa.Table:
        b = _Block(block, replies, width, key_width)
        positions = b.tied(exchange.answers(replies, 0, b.keys, sample_bits, key_width))
        keys, inverse, least = b.strings(positions)
        smaller = exchange.answers(replies, 1, keys, bits) > 0
        gone = positions[smaller[inverse] | (least[inverse] < b.own[b.doc[positions]])]
        steps = np.zeros(len(b.raw) + 1, np.int32)
        steps[gone] += 1
        steps[gone + width] -= 1
        for i in b.copies:
            if b.at[i + 1] - b.at[i] >= width:
                steps[b.at[i]] += 1
                steps[b.at[i + 1]] -= 1
        removed = np.cumsum(steps[:-1]) > 0
        first = removed.copy()
        first[1:] &= ~removed[:-1] | (b.doc[1:] != b.doc[:-1])
        sums = np.concatenate([[0], np.cumsum(removed)])
        starts = np.concatenate([[0], np.cumsum(first)])
        sha, kept, spans = [], [], []
        for lo, hi in zip(b.at[:-1], b.at[1:]):
            stays = b.raw[lo:hi][~removed[lo:hi]].tobytes() if sums[hi] > sums[lo] else b.raw[lo:hi].tobytes()
            sha.append(hashlib.sha256(stays).hexdigest())
            if with_text:
                edge = np.flatnonzero(np.diff(removed[lo:hi].astype(np.int8), prepend=0, append=0))
                kept.append(stays)
                spans.append([{"start": int(s), "stop": int(e)} for s, e in edge.reshape(-1, 2)])
        columns = {"doc_id": id_array(b.own), "n_bytes": pa.array(np.diff(b.at)), "n_removed": pa.array(np.diff(sums[b.at])),
                   "n_spans": pa.array(np.diff(starts[b.at])), "kept_sha256": pa.array(sha, pa.string())}
        if with_text:
            columns |= {"spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                        "kept": pa.array(kept, pa.binary())}
        return pa.table(columns)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        out += ", spans array<struct<start:long,stop:long>>, kept binary"
    done = stage(told(ranks.unionByName(below).unionByName(copies), cut, out), "suffix-cut", BLOCK_ROWS)
    discard(table, texts, first, copies, ranks, below)
    return done
