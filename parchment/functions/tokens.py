"""The tokens of TOKEN_PATTERN of many texts at once, from their UTF-8 bytes.

The pattern is a letter or digit and all letters, digits, ``'`` and ``-`` that
follow; so each stretch of such characters has one token, from its first
letter or digit on, or none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_KIND = np.zeros(256, np.uint8)
_KIND[list(b"'-")] = 1
_KIND[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 2


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array, concatenated, and its n + 1 offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def split_tokens(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The tokens of the lower-case texts ``data[ends[i]:ends[i + 1]]``, and how many each text has."""
    kind = _KIND[data]
    inside = kind > 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    border = ends[(ends > 0) & (ends < len(data))]  # a stretch ends with its text
    opens[border] |= inside[border]
    closes[border - 1] |= inside[border - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    late = np.flatnonzero(kind[first] == 1)
    if len(late):
        letters = np.append(np.flatnonzero(kind == 2), len(data))
        begin = np.minimum(letters[np.searchsorted(letters, first[late])], last[late])
        skipped = begin - first[late]
        inside[np.repeat(first[late] - np.cumsum(skipped) + skipped, skipped) + np.arange(skipped.sum())] = False
        first[late] = begin
        whole = first < last
        first, last = first[whole], last[whole]
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return words, np.diff(np.searchsorted(first, ends))
