"""Scalar text expressions (all JVM-side, inside whole-stage codegen where possible)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parchment.constants import LINE_BREAK, STOPWORDS, TOKEN_PATTERN, WS_CLASS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def collapse_ws(col) -> Column:
    """Collapse every whitespace run to one space and strip."""
    return strip_ws(F.regexp_replace(_c(col), f"{WS_CLASS}+", " "))


def words(col) -> Column:
    """``str.split()`` – whitespace-separated words, no empty strings (one regex pass; the ends may leave some)."""
    return F.array_remove(F.split(_c(col), f"{WS_CLASS}+"), "")


def word_count(col) -> Column:
    return F.size(words(col)).cast("int")


def normalize_lines(col) -> Column:
    """Split lines, strip each, drop blanks, join by newline, collapse [ \\t]+."""
    lines = F.transform(F.split(_c(col), LINE_BREAK), lambda x: strip_ws(x))
    kept = F.filter(lines, lambda x: x != "")
    return F.regexp_replace(F.array_join(kept, "\n"), "[ \t]+", " ")


def tokens(col) -> Column:
    """C4: lower-case regex tokens (positions are array indexes)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), 0)


def content_tokens(col) -> Column:
    """C4 + C5: tokens without the stop words."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(tokens(col), lambda t: ~F.array_contains(stop, t))


def sha256_hex(*cols) -> Column:
    """SHA-256 hex of a string (or of several joined by ':')."""
    if len(cols) == 1:
        return F.sha2(_c(cols[0]), 256)
    return F.sha2(F.concat_ws(":", *[_c(c).cast("string") for c in cols]), 256)


def ilike_contains(col, pattern_text) -> Column:
    """``pattern IS NULL OR col ILIKE '%' || trim(pattern) || '%'`` (blank = no filter).

    The user's text is not escaped: ``%`` and ``_`` inside act as wildcards,
    as in the reference.
    """
    p = strip_ws(_c(pattern_text))
    return (_c(pattern_text).isNull() | (p == "")
            | F.ilike(_c(col), F.concat(F.lit("%"), p, F.lit("%"))))
