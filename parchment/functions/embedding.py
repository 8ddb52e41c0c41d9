"""Deterministic signed feature-hashing embeddings.

Features are the content tokens (weight 1.0) and adjacent-token bigrams
``left_right`` (weight 1.5).  A feature's 64-bit hash value ``v`` gives both
the slot (``v % dim``) and the sign (negative when ``v`` is odd), so odd slots
are never positive and even slots never negative.  The vector is L2
normalised and rounded to 8 digits; a text without tokens stays all zero.

Spark has no BLAKE2b, so the per-row work is a small Arrow-batched pandas UDF
(map-only, no shuffle).  Two feature hashes are offered:

* ``local_hashing_v1``      BLAKE2b with an 8-byte digest, big-endian integer.
* ``local_hashing_sha_v1``  first 15 hex digits of SHA-256 – identical
  vectors can be computed by plain SQL, which is how the retrieval operators
  are checked against an independent engine.
"""

from __future__ import annotations

import hashlib
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parchment.constants import (BIGRAM_WEIGHT, EMBEDDING_DIMENSION, EMBEDDING_MODEL,
                                 EMBEDDING_ROUND_DIGITS, SHA_EMBEDDING_MODEL, STOPWORDS,
                                 UNIGRAM_WEIGHT)
from parchment.functions.tokens import split_tokens, utf8

_STOP = frozenset(STOPWORDS)


def _blake2b_value(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode("utf-8"), digest_size=8).digest(), "big")


def _sha_value(feature: str) -> int:
    return int(hashlib.sha256(feature.encode("utf-8")).hexdigest()[:15], 16)


HASHERS = {EMBEDDING_MODEL: _blake2b_value, SHA_EMBEDDING_MODEL: _sha_value}


def _blake2b_values(features: list[str]) -> np.ndarray:
    digest = hashlib.blake2b
    return np.frombuffer(b"".join([digest(f.encode(), digest_size=8).digest() for f in features]), ">u8").astype(np.uint64)


def _sha_values(features: list[str]) -> np.ndarray:
    """15 hex digits are the first 60 bits."""
    digest = hashlib.sha256
    whole = b"".join([digest(f.encode()).digest() for f in features])
    return np.frombuffer(whole, ">u8")[::4].astype(np.uint64) >> np.uint64(4)


# The same values for many features at once.
DIGESTS = {EMBEDDING_MODEL: _blake2b_values, SHA_EMBEDDING_MODEL: _sha_values}


# Texts that are numbered together: more do not fit a processor's cache.
_TEXTS = 1024


def embed_batch(texts: pd.Series, model: str = EMBEDDING_MODEL, dimension: int = EMBEDDING_DIMENSION) -> np.ndarray:
    """The (rows, dimension) matrix of a batch of texts: every distinct feature is hashed once (words and pairs are
    numbered, so no text is compared), all occurrences are summed by one ``bincount`` over (row, slot)."""
    found, sizes = split_tokens(*utf8(pa.array([t.lower() if isinstance(t, str) else "" for t in texts], pa.string())))
    coded = found.dictionary_encode()
    code, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False)
    kept = ~np.array([w in _STOP for w in words], bool)[code]
    row, token = np.repeat(np.arange(len(texts)), sizes)[kept], code[kept].astype(np.int64)
    pair = np.flatnonzero(row[1:] == row[:-1])
    both, pairs = pd.factorize(token[pair] * len(words) + token[pair + 1])
    left, right = np.divmod(pairs, max(1, len(words)))
    lefts = np.array([w + "_" for w in words], object)
    names = [*words, *map(add, lefts[left].tolist(), words[right].tolist())]
    feature = np.concatenate([token, both + len(words)]).astype(np.int64)
    values = DIGESTS[model](names)
    slot = (values % np.uint64(dimension)).astype(np.int64)[feature]
    sign = 1.0 - 2.0 * (values & np.uint64(1)).astype(float)[feature]
    weight = np.repeat([UNIGRAM_WEIGHT, BIGRAM_WEIGHT], [len(token), len(pair)])
    total = np.bincount(np.concatenate([row, row[pair]]) * dimension + slot, sign * weight, len(texts) * dimension)
    matrix = total.reshape(len(texts), dimension).astype(float)  # bincount of nothing is integer
    norms = np.sqrt((matrix * matrix).sum(1, keepdims=True))
    return np.round(np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0), EMBEDDING_ROUND_DIGITS)


def _make_udf(model: str, dimension: int):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(texts: pd.Series) -> pd.Series:
        parts = [embed_batch(texts.iloc[at:at + _TEXTS], model, dimension) for at in range(0, len(texts), _TEXTS)]
        return pd.Series([v for part in parts for v in part.astype(np.float32)], dtype=object)
    return _embed


_UDFS: dict = {}


def embed(col, model: str = EMBEDDING_MODEL, dimension: int = EMBEDDING_DIMENSION) -> Column:
    """Column expression: text -> array<float>(dimension)."""
    key = (model, dimension)
    if key not in _UDFS:
        _UDFS[key] = _make_udf(model, dimension)
    return _UDFS[key](F.col(col) if isinstance(col, str) else col)


def vector_literal(col) -> Column:
    """``[a,b,...]`` text form of a vector."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit("]"))


def parse_vector_literal(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, "array<float>")


def l2_norm(col) -> Column:
    """Euclidean length of an array column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sqrt(F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """``1 - cosine distance``; zero vectors give 0.0 instead of NaN."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    den = l2_norm(a) * l2_norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot / den)
