"""Golomb-coded fingerprint exchange: which fingerprints of a block also occur in other blocks?

Every block (a bounded share of the rows) sends each owner the sorted
distinct fingerprints that fall into the owner's range, as one Golomb-Rice
coded row.  An owner decodes and sorts its range, which is one bounded bucket,
and answers every block with one code per fingerprint, in the order sent.
A fingerprint that a third of all rows share is one entry per block, so hot
values are gathered before the shuffle and no owner grows with their copies.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

REQUEST = "owner int, block long, coded binary, extra binary"
REPLY = "block long, kind int, owner int, codes binary"
_REQUEST = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("coded", pa.binary()), ("extra", pa.binary())])
_REPLY = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("owner", pa.int32()), ("codes", pa.binary())])


def golomb(values: np.ndarray, low: int, span: int) -> bytes:
    """Sorted distinct uint64 values of [low, low + span) as Golomb-Rice coded gaps.

    Quotients are a unary bit stream; remainders keep their low bytes as
    bytes and the bits above those packed.
    """
    n = len(values)
    if not n:
        return struct.pack("<IB", 0, 0)
    k = max(0, int(math.log2(max(1.0, span / n))))
    gaps = np.diff(values, prepend=np.uint64(low))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    rest = gaps & np.uint64((1 << k) - 1)
    whole, over = divmod(k, 8)
    planes = rest.astype("<u8").view(np.uint8).reshape(n, 8)[:, :whole].T.tobytes()
    top = (rest >> np.uint64(8 * whole)).astype(np.uint8)
    bits = np.packbits(top[:, None] >> np.arange(over, dtype=np.uint8) & 1).tobytes() if over else b""
    return struct.pack("<IB", n, k) + planes + bits + np.packbits(unary).tobytes()


def ungolomb(coded: bytes, low: int) -> np.ndarray:
    """The inverse of :func:`golomb`."""
    n, k = struct.unpack_from("<IB", coded)
    if not n:
        return np.zeros(0, np.uint64)
    whole, over = divmod(k, 8)
    raw = np.frombuffer(coded, np.uint8, offset=5)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :whole] = raw[:n * whole].reshape(whole, n).T
    rest = rest.reshape(-1).view("<u8").astype(np.uint64)
    at = n * whole
    if over:
        size = (n * over + 7) // 8
        bits = np.unpackbits(raw[at:at + size], count=n * over).reshape(n, over)
        rest |= (bits @ (1 << np.arange(over))).astype(np.uint64) << np.uint64(8 * whole)
        at += size
    ends = np.flatnonzero(np.unpackbits(raw[at:]) == 0)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    return np.uint64(low) + np.cumsum((quotient.astype(np.uint64) << np.uint64(k)) | rest, dtype=np.uint64)


def owner_bits(entries: int, per_owner: int = 1 << 20) -> int:
    """Owners are as many as keep the expected entries of one within ``per_owner`` (64 at least)."""
    return max(6, math.ceil(math.log2(max(1, entries / per_owner))))


def requests(block: int, values: np.ndarray, bits: int, width: int = 64, extra: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per owner for a block's sorted distinct fingerprints (and a value for each)."""
    span = 1 << (width - bits)
    cuts = np.searchsorted(values, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits))
    cuts = np.concatenate([[0], cuts, [len(values)]])
    owners = np.flatnonzero(np.diff(cuts))
    press = zstandard.ZstdCompressor(level=3).compress
    return pa.record_batch([
        pa.array(owners, pa.int32()), pa.array([block] * len(owners), pa.int64()),
        pa.array([golomb(values[cuts[o]:cuts[o + 1]], int(o) * span, span) for o in owners], pa.binary()),
        pa.array([None if extra is None else press(extra[cuts[o]:cuts[o + 1]].tobytes()) for o in owners], pa.binary()),
    ], schema=_REQUEST)


def _decoded(t: pa.Table, width: int, bits: int) -> tuple[int, np.ndarray, np.ndarray]:
    owner = t["owner"][0].as_py()
    parts = [ungolomb(c.as_py(), owner << (width - bits)) for c in t["coded"]]
    return owner, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def _replies(t: pa.Table, owner: int, kind: int, codes: list[bytes]) -> pa.Table:
    n = t.num_rows
    return pa.table([t["block"], pa.array([kind] * n, pa.int32()), pa.array([owner] * n, pa.int32()),
                     pa.array(codes, pa.binary())], schema=_REPLY)


def shared(asked: DataFrame, bits: int, width: int = 64, kind: int = 0) -> DataFrame:
    """Answers a bitmap: 1 where at least one other block sent the fingerprint too."""

    def answer(t: pa.Table) -> pa.Table:
        owner, values, cuts = _decoded(t, width, bits)
        order = np.argsort(values)
        ranked = values[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(values), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        return _replies(t, owner, kind, [np.packbits(twice[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])])

    return asked.groupBy("owner").applyInArrow(answer, REPLY)


def spread(asked: DataFrame, bits: int, width: int = 64, kind: int = 0) -> DataFrame:
    """Answers a byte: the bit length of the number of blocks that sent the fingerprint."""

    def answer(t: pa.Table) -> pa.Table:
        owner, values, cuts = _decoded(t, width, bits)
        _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        code = np.frexp(counts.astype(float))[1].astype(np.uint8)[inverse]
        press = zstandard.ZstdCompressor(level=3).compress
        return _replies(t, owner, kind, [press(code[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])])

    return asked.groupBy("owner").applyInArrow(answer, REPLY)


def undercut(asked: DataFrame, bits: int, width: int = 64, kind: int = 0) -> DataFrame:
    """Answers a bitmap: 1 where another block sent the fingerprint with a smaller value."""

    def answer(t: pa.Table) -> pa.Table:
        owner, values, cuts = _decoded(t, width, bits)
        unpress = zstandard.ZstdDecompressor().decompress
        own = np.concatenate([np.frombuffer(unpress(x.as_py()), np.int64) for x in t["extra"]])
        order = np.argsort(values)
        ranked = values[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        least = np.minimum.reduceat(own[order], starts)
        below = np.empty(len(values), bool)
        below[order] = np.repeat(least, np.diff(np.append(starts, len(values)))) < own[order]
        return _replies(t, owner, kind, [np.packbits(below[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])])

    return asked.groupBy("owner").applyInArrow(answer, REPLY)


def answers(replies: pa.Table, kind: int, values: np.ndarray, bits: int, width: int = 64, packed: bool = True) -> np.ndarray:
    """A block's answers in the order of its sorted distinct fingerprints."""
    cuts = np.searchsorted(values, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits))
    cuts = np.concatenate([[0], cuts, [len(values)]])
    out = np.zeros(len(values), np.uint8)
    unpress = zstandard.ZstdDecompressor().decompress
    for k, owner, codes in zip(*(replies[c].to_pylist() for c in ("kind", "owner", "codes"))):
        if k == kind:
            a, b = cuts[owner], cuts[owner + 1]
            out[a:b] = np.unpackbits(np.frombuffer(codes, np.uint8), count=b - a) if packed else np.frombuffer(unpress(codes), np.uint8)
    return out
