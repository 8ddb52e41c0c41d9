"""License scan: counts of shared 3-grams propose, local alignment decides.

Templates and texts are compared by their letters and digits, lower-cased.
A stretch of text that reaches the coverage shares a number of 3-grams with
the template that follows from the template's length; stretches with fewer
are passed over.  In the others, local alignment of the template gives the
matched characters and the span of every occurrence.  Everything is local to
a row: no shuffle.  The counting takes one pass over a text per template.
"""

from __future__ import annotations

import bisect
import collections
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import id_array, ids, utf8

GRAM = 3
BAND = 24  # letters that an occurrence may have more than its template, and still be seen in one window
COVERAGE = 0.8
MAX_TEMPLATE_BYTES = 8 << 20  # bound of what travels with the tasks
MAX_LETTERS = 1 << 18  # of one template: what a packed path holds
_STEP = 1 << 21

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                      "that the following conditions are met:",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 'documentation files (the "Software"), to deal in the Software without restriction',
    "MIT-short": "Released under the MIT License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_BYTE = np.arange(256)
_SOLID = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_FOLD = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def _plain(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.flatnonzero(_SOLID[raw])
    return _FOLD[raw[place]], place


_SIX = np.where(_FOLD >= 128, 36 + _FOLD % 28, np.where(_FOLD >= 97, _FOLD - 87, _FOLD - 48)).astype(np.int32) & 63


def _grams(plain: np.ndarray) -> np.ndarray:
    """The 3-gram at each position as a number of 18 bits; equal for some 3-grams with bytes outside ASCII."""
    x = _SIX[plain]
    return x[:-2] << 12 | x[1:-1] << 6 | x[2:]


def least_shared(n: int, least: int) -> int:
    """3-grams that a text shares with a template of ``n`` letters if it matches ``least`` of them or more.

    The matched letters lie in runs, one more than the places where letters
    were changed, dropped or added; a run of r letters holds r - 2 grams.
    Places are taken to be n - least at most, as many as letters may go unmatched.
    """
    return max(1, least - (GRAM - 1) * (n - least + 1))


def stretches(shared: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the stretches of text in which some window of n + 2 BAND letters shares enough grams.

    ``shared`` counts the positions before each one whose gram is in the template.
    """
    width = n + 2 * BAND
    reach = width - GRAM + 1
    later = np.concatenate([shared[reach:], np.full(min(reach, len(shared)), shared[-1])])
    at = np.flatnonzero(later - shared >= least_shared(n, least))
    if not len(at):
        return at, at
    new = np.flatnonzero(np.diff(at) > width + 2 * BAND) + 1
    return at[np.concatenate([[0], new])] - BAND, at[np.concatenate([new - 1, [-1]])] + width + BAND


def on_nearby_diagonals(own: np.ndarray, grams: np.ndarray, n: int, least: int) -> bool:
    """Whether enough shared grams lie on diagonals no further apart than an occurrence's added and dropped letters take them."""
    order = np.argsort(own, kind="stable")
    lo, hi = np.searchsorted(own[order], grams, "left"), np.searchsorted(own[order], grams, "right")
    count = hi - lo
    index = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    diagonal = np.sort(np.repeat(np.arange(len(grams)), count) - order[index])
    enough = least_shared(n, least)
    return bool((diagonal[enough - 1:] - diagonal[:max(0, len(diagonal) - enough + 1)] <= 2 * (BAND + n - least)).any())


# A path's score, matched letters and start, packed so that the larger number is the better path.
_START_BITS, _MATCHED_BITS = 21, 20
_MATCH = 1 << _START_BITS
_POINT = 1 << _START_BITS + _MATCHED_BITS
_TILE = 1 << 16


def _ends(template: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """The best path to each end in ``text`` that matches ``least`` letters or more; 0 where there is none."""
    at = np.arange(len(text) + 1)
    slope = at * _POINT
    path, best = at, np.zeros(len(at), np.int64)
    for i, letter in enumerate(template):
        row = path - _POINT
        row[1:] = np.maximum(row[1:], path[:-1] + np.where(text == letter, _POINT + _MATCH, -_POINT))
        row = np.maximum.accumulate(row + slope) - slope
        path = np.where(row < _POINT, at, row)  # an empty path starts anywhere
        if i + 1 >= least:
            best = np.maximum(best, np.where((path // _MATCH) % (1 << _MATCHED_BITS) >= least, path, 0))
    return best


def _apart(template: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    best = _ends(template, text, least)
    stops = np.flatnonzero(best)
    starts, worth = best[stops] % _MATCH, best[stops] // _MATCH
    kept: list[tuple[int, int, int]] = []
    for x in np.lexsort((starts, -worth)).tolist():
        start, stop = int(starts[x]), int(stops[x])
        k = bisect.bisect(kept, (start,), key=lambda y: y[1:2])
        if (k == 0 or kept[k - 1][2] <= start) and (k == len(kept) or stop <= kept[k][1]):
            kept.insert(k, (int(worth[x] % (1 << _MATCHED_BITS)), start, stop))
    out = list(kept)
    for lo, hi in zip([x[2] for x in kept], [x[1] for x in kept[1:]] + [len(text)]):
        inside = (stops > lo) & (stops <= hi)
        if hi - lo >= least and inside.any():  # their best paths run into the kept one before; others may not
            out += [(m, start + lo, stop + lo) for m, start, stop in _apart(template, text[lo:hi], least)]
    return out


def occurrences(template: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(matched, start, stop) of the local alignments in ``text`` that match ``least`` letters of the template or more.

    A match counts 1, a mismatch or gap -1.  They do not overlap: of those
    that do, the higher score stays, then the more matched, then the earlier.
    """
    n, out = len(template), []
    tile, least = max(_TILE, 4 * n), max(1, least)
    for first in range(0, len(text), tile):  # an alignment spans less than 2 n letters
        lo = max(0, first - 2 * n)
        out += [(m, start + lo, stop + lo) for m, start, stop in _apart(template, text[lo:first + tile + 2 * n], least)
                if first <= start + lo < first + tile]
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license, coverage, start, stop: one row per occurrence of a template in a text.

    ``coverage`` is the share of the template's letters and digits that the
    alignment matches, at least the given one; start and stop are byte offsets
    into the UTF-8 text.  Occurrences in a text do not overlap (that with
    more matched letters stays, then the better covered, then the earlier).  Null and empty
    texts have none; repeated rows are scanned each; a null doc_id stays
    null; empty table: empty result; other columns of ``docs`` are not read.
    Templates of fewer than ``GRAM`` letters and digits match nothing.

    None is missed that lies within 2 ``BAND`` letters more than its template has
    and differs from it in no more places than letters may go unmatched (a run
    of changed, dropped or added letters is one place), if ``coverage`` is 0.8
    and the template has 8 letters or more; ``least_shared`` has the reckoning.
    """
    given = sorted((TEMPLATES if templates is None else templates).items())
    if sum(len(t) for _, t in given) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates above {MAX_TEMPLATE_BYTES} bytes: scan them in groups")
    names = [n for n, _ in given]
    bodies = [_plain(np.frombuffer(t.encode(), np.uint8))[0] for _, t in given]
    if any(len(body) >= MAX_LETTERS for body in bodies):
        raise ValueError(f"a template of {MAX_LETTERS} letters and digits or more: cut it into parts")
    leasts = [max(1, math.ceil(coverage * len(body) - 1e-9)) for body in bodies]

    def aligned(t: int, plain: np.ndarray, where: list[tuple[int, int]]):
        """(t, matched, start, stop) of template t in the given stretches; all in one alignment, far enough apart."""
        body = bodies[t]
        gap = np.zeros(len(body), np.uint8)  # no letter: crossing it costs more than the template can score
        text = np.concatenate([y for lo, hi in where for y in (plain[lo:hi], gap)])
        first = np.cumsum([0] + [hi - lo + len(body) for lo, hi in where])
        for matched, start, stop in occurrences(body, text, leasts[t]):
            k = int(np.searchsorted(first, start, "right")) - 1
            shift = where[k][0] - int(first[k])
            yield t, matched, start + shift, stop + shift

    def found(plain: np.ndarray, cuts: np.ndarray):
        """text -> its occurrences (template, matched, start, stop), in the letters and digits of all texts."""
        best = collections.defaultdict(list)
        if len(plain) < GRAM:
            return best
        grams, known = _grams(plain), np.zeros(1 << 18, bool)
        for t, body in enumerate(bodies):
            if len(body) < GRAM:
                continue
            own, n, where = _grams(body), len(body), []
            known[own] = True
            shared = np.zeros(len(grams) + 1, np.int32)
            np.cumsum(known[grams], out=shared[1:])
            known[own] = False
            enough = least_shared(n, leasts[t])
            for start, stop in zip(*stretches(shared, n, leasts[t])):
                i = max(0, int(np.searchsorted(cuts, start, "right")) - 1)
                while i + 1 < len(cuts) and cuts[i] < stop:
                    lo, hi = int(max(start, cuts[i])), int(min(stop, cuts[i + 1]))
                    if (hi - lo >= max(GRAM, leasts[t]) and shared[hi - GRAM + 1] - shared[lo] >= enough
                            and (n <= 2 * BAND or on_nearby_diagonals(own, grams[lo:hi - GRAM + 1], n, leasts[t]))):
                        where.append((lo, hi))
                    i += 1
            if where:
                for x in aligned(t, plain, where):
                    best[int(np.searchsorted(cuts, x[2], "right")) - 1].append(x)
        return {i: apart(best[i]) for i in sorted(best)}

    def apart(best: list[tuple[int, int, int, int]]):
        kept: list[tuple[int, int, int, int]] = []  # by place
        for x in sorted(best, key=lambda x: (-x[1], -x[1] / len(bodies[x[0]]), x[2], x[0])):
            k = bisect.bisect(kept, x[2], key=lambda y: y[2])
            if (k == 0 or kept[k - 1][3] <= x[2]) and (k == len(kept) or x[3] <= kept[k][2]):
                kept.insert(k, x)
        return kept

    def apply(batches):
        for batch in batches:
            own, (raw, at), out = ids(batch.column(0)), utf8(batch.column(1)), []
            first = 0
            while first < len(own):
                last = min(len(own), max(first + 1, int(np.searchsorted(at, at[first] + _STEP, "right")) - 1))
                here = raw[at[first]:at[last]]
                plain, where = _plain(here)
                cuts = np.searchsorted(where, at[first:last + 1] - at[first])
                for i, spans in found(plain, cuts).items():
                    base = at[first + i] - at[first]
                    for t, matched, start, stop in spans:
                        out.append((first + i, t, matched / len(bodies[t]), int(where[start] - base), int(where[stop - 1] - base + 1)))
                first = last
            yield pa.record_batch([
                id_array(own[np.array([x[0] for x in out], np.int64)]), pa.array([names[x[1]] for x in out], pa.string()),
                pa.array([x[2] for x in out], pa.float64()), pa.array([x[3] for x in out], pa.int64()),
                pa.array([x[4] for x in out], pa.int64())], names=["doc_id", "license", "coverage", "start", "stop"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        apply, "doc_id long, license string, coverage double, start long, stop long")
