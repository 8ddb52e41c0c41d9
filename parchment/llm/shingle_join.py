"""N-gram Jaccard join with several global token orders.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches the rule.  Equal sets are one class.  Under any global order of the
tokens, linked sets share a token among their first n - ceil(t n) + 1, so a
pair is a candidate only if that holds under every one of ``ORDERS`` orders.
All orders put rare shingles first (document spread from the fingerprint
exchange), each breaks ties its own way; shingles that no other document has
are never sent, so documents without relatives send nothing.

Large groups: first every candidate meets only the hub of its bucket, and what
links becomes one component.  Hub rounds repeat, with other orders and hubs,
while they still find links for over one in a hundred candidates; then all
remaining candidate pairs of different components are verified.  So every
link that joins two components is found, and no group is expanded into pairs.
A shared token counts only if its places in both orders leave room for the
intersection that the rule asks for.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm import blocks, exchange
from parchment.llm.common import BLOCK_ROWS, NO_ID, mix, stage, whole
from parchment.llm.components import components

ORDERS = 3
HUB_ROUNDS = 6
_STEP = 1 << 21
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked when 100 * intersection >= ``percent`` * union."""

    words: int
    percent: int

    def linked(self, both: int, n: int, m: int) -> bool:
        return 100 * both >= self.percent * (n + m - both)


QUERY_RULE = Rule(4, 85)
STAGE_RULE = Rule(5, 80)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.up) < n:
        size = max(n, _STEP + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            setattr(_powers, name, np.cumprod(p, dtype=np.uint64))
    return _powers.up[:n], _powers.down[:n]


_powers.up = _powers.down = np.zeros(0, np.uint64)


def _words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, in order, and the number of words of each."""
    n = len(at) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    solid = ~_BLANK[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True
    first = np.flatnonzero(solid & (cut[:-1] | np.concatenate([[True], ~solid[:-1]])))
    last = np.flatnonzero(solid & (cut[1:] | np.concatenate([~solid[1:], [True]])))
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[raw] + np.uint64(1)) * up[:-1], dtype=np.uint64)])
    size = (last + 1 - first).astype(np.uint64)
    return mix((total[last + 1] - total[first]) * down[first] ^ mix(size)), np.diff(np.searchsorted(first, at))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + p)
    return h


def shingle_sets(raw: np.ndarray, at: np.ndarray, words: int):
    """Yields each text's sorted distinct shingle hashes; fewer words: the sequence as one; none: empty."""
    n, first = len(at) - 1, 0
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(at, at[first] + _STEP, "right")) - 1))
        w, counts = _words(raw[at[first]:at[last]], at[first:last + 1] - at[first])
        k = max(0, len(w) - words + 1)
        whole = _fold([w[i:i + k] for i in range(words)]) if k else np.zeros(0, np.uint64)
        stops = np.cumsum(counts)
        for stop, c in zip(stops.tolist(), counts.tolist()):
            if c >= words:
                yield np.unique(whole[stop - c:stop - words + 1])
            elif c:
                yield _fold([w[i:i + 1] for i in range(stop - c, stop)])
            else:
                yield np.zeros(0, np.uint64)
        first = last


def _entries(rule: Rule):
    """The side bytes of a block: set size (8 bytes) and signature (16 bytes) of each document."""

    def side(raw, at):
        return b"".join(len(s).to_bytes(8, "little") + hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                        for s in shingle_sets(raw, at, rule.words))

    return side


def _listed(batches):
    for block in blocks.each(batches):
        row = block.to_pylist()[0]
        side = np.frombuffer(row["side"] or b"", np.uint8).reshape(-1, 24)
        own = np.frombuffer(row["ids"], np.int64)
        yield pa.record_batch([
            pa.array(own, mask=own == NO_ID), pa.array(np.ascontiguousarray(side[:, :8]).view(np.int64).reshape(-1)),
            pa.array([x.tobytes() for x in side[:, 8:]], pa.binary())], names=["doc_id", "n", "sig"])


def _prefixes(rule: Rule, bits: int, width: int):
    """Cogroup: a block and its answers -> the documents that may have relatives, with their prefix tokens by order."""
    drop = np.uint64(64 - width)

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        _, own, raw, at = blocks.opened(block)
        sets = list(shingle_sets(raw, at, rule.words))
        distinct, inverse, here = np.unique(
            np.concatenate([*sets, np.zeros(0, np.uint64)]) >> drop, return_inverse=True, return_counts=True)
        code = exchange.answers(replies, 0, distinct, bits, width, packed=False)
        spread, common = code[inverse], ((code > 1) | (here > 1))[inverse]
        out, stop = [], 0
        for doc, s in zip(own.tolist(), sets):
            stop += len(s)
            mine, n = slice(stop - len(s), stop), len(s)
            if not n or doc == NO_ID or not common[mine].any():
                continue
            length = n + rule.percent * n // -100 + 1
            tokens, places = [], []
            for k in range(ORDERS):
                order = np.lexsort((mix(s ^ np.uint64(0xA0761D6478BD642F * (k + 1) & _MASK)), spread[mine]))[:length]
                places.append(np.flatnonzero(common[mine][order]))
                tokens.append(s[order[places[-1]]].view(np.int64))
            if all(len(t) for t in tokens):
                out.append((doc, n, s.tobytes(), *tokens, *places))
        cols = list(zip(*out)) or [[]] * (3 + 2 * ORDERS)
        kinds = [pa.int64(), pa.int64(), pa.binary()] + [pa.list_(pa.int64())] * (2 * ORDERS)
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)],
                        names=["doc", "n", "tokens", *(f"t{k}" for k in range(ORDERS)), *(f"p{k}" for k in range(ORDERS))])

    return run


def _verified(pairs: DataFrame, known: DataFrame, rule: Rule, name: str) -> DataFrame:
    """Of pairs (a, b) those that link: every order's prefixes must meet before the sets are compared."""
    need = ["doc", "tokens", *(f"t{k}" for k in range(ORDERS))]
    left = known.select(*(F.col(c).alias(f"l_{c}") for c in need))
    right = known.select(*(F.col(c).alias(f"r_{c}") for c in need))
    meets = F.lit(True)
    for k in range(ORDERS):
        meets = meets & F.arrays_overlap(f"l_t{k}", f"r_t{k}")
    rows = (pairs.join(left, F.col("a") == F.col("l_doc")).join(right, F.col("b") == F.col("r_doc"))
            .where(meets).select("a", "b", "l_tokens", "r_tokens"))

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(rule.linked(both, len(x), len(y)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return stage(rows.mapInArrow(compare, "a long, b long"), name)


def _room_for(rule: Rule, n: str, room: str, m: str, other: str):
    """A token that two sets share leaves room for a large enough intersection.

    ``room`` and ``other`` are the sets' sizes from the token's place in the
    order on.  It holds at the first token that a linked pair shares, so a
    pair that fails at each of its tokens does not link.
    """
    return (100 + rule.percent) * F.least(F.col(room), F.col(other)) >= rule.percent * (F.col(n) + F.col(m))


def _links(known: DataFrame, rule: Rule) -> DataFrame:
    """node, component over the candidates (one row per class of equal sets)."""
    found: DataFrame | None = None

    def placed(k: int) -> DataFrame:
        flat = known.select("doc", "n", F.explode(F.arrays_zip(F.col(f"t{k}").alias("token"), F.col(f"p{k}").alias("place"))).alias("at"))
        flat = flat.select("doc", "n", "at.token", "at.place")
        if found is None:
            return flat.withColumn("component", F.col("doc"))
        return (flat.join(found, F.col("doc") == F.col("node"), "left")
                .withColumn("component", F.coalesce("component", "doc")).drop("node"))

    def joined(new: DataFrame) -> DataFrame:
        return components(new if found is None else new.unionByName(
            found.select(F.col("node").alias("a"), F.col("component").alias("b"))), "join-components")

    total, growth = known.count(), math.log(100 / rule.percent)
    for turn in range(HUB_ROUNDS):
        at = placed(turn % ORDERS).withColumn("class", F.floor(F.log(F.col("n").cast("double")) / growth + turn / 2))
        rank = F.col("doc") if turn == 0 else F.xxhash64("component", F.lit(turn))
        at = at.withColumn("room", F.col("n") - F.col("place"))
        hubs = at.groupBy("token", "class").agg(F.min(F.struct(rank.alias("rank"), "doc", "n", "room", "component")).alias("hub"))
        pairs = (at.join(hubs, ["token", "class"]).where("component <> hub.component")
                 .where(_room_for(rule, "n", "room", "hub.n", "hub.room"))
                 .select(F.greatest("doc", "hub.doc").alias("a"), F.least("doc", "hub.doc").alias("b")).distinct())
        new = _verified(pairs, known, rule, "join-hub-links")
        links = new.count()
        if links:
            found = joined(new)
        if 100 * links <= total:
            break
    # Components meet first and documents only through them, so no two documents of one component are paired.
    # What meets is the documents of a component and size class that hold a token: if even the largest room and
    # the smallest size among them do not allow a link, none of their documents is paired there.
    left = placed(0).withColumn("class", F.floor(F.log(F.col("n").cast("double")) / growth)).withColumn("room", F.col("n") - F.col("place"))
    several = left.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where(
        "least < most").select(F.col("token").alias("s_token"))
    left = stage(left.join(several, F.col("token") == F.col("s_token"), "left_semi"), "join-rest")

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*(F.col(c).alias(prefix + c) for c in df.columns))

    held = left.groupBy("token", "component", "class").agg(F.min("n").alias("n"), F.max("room").alias("room"))
    meet = named(held, "h_").join(named(held, "g_"), (F.col("h_token") == F.col("g_token")) & (F.col("h_component") < F.col("g_component"))
                                  & _room_for(rule, "h_n", "h_room", "g_n", "g_room")).drop("h_n", "h_room")
    ours = meet.join(left, (F.col("h_token") == F.col("token")) & (F.col("h_component") == F.col("component"))
                     & (F.col("h_class") == F.col("class")) & _room_for(rule, "n", "room", "g_n", "g_room"))
    ours = ours.select("doc", "n", "room", "g_token", "g_component", "g_class")
    pairs = (ours.join(named(left, "o_"), (F.col("g_token") == F.col("o_token")) & (F.col("g_component") == F.col("o_component"))
                       & (F.col("g_class") == F.col("o_class")) & _room_for(rule, "n", "room", "o_n", "o_room"))
             .select(F.greatest("doc", "o_doc").alias("a"), F.least("doc", "o_doc").alias("b")).distinct())
    return joined(_verified(pairs, known, rule, "join-links"))


def shingle_components(docs: DataFrame, rule: Rule = QUERY_RULE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the
    distinct shingles of ``rule.words`` words (fewer words: the sequence as
    one).  ``component_id`` is the smallest doc_id reachable by links.  Null
    or blank texts have an empty set and link with nothing, not even each
    other.  A row without doc_id links with nothing (component_id null).
    Rows with one doc_id are one vertex.  Empty table: empty result.  Other
    columns of ``docs`` are not read.
    """
    table = blocks.build(docs, "join-blocks", _entries(rule), doc_id, text)
    listed = stage(table.select("block", "ids", "side").mapInArrow(_listed, "doc_id long, n long, sig binary"), "join-sets", BLOCK_ROWS)
    entries = listed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    classes = stage(listed.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("first")), "join-classes")
    bits = exchange.owner_bits(entries)
    width = min(64, max(24, math.ceil(math.log2(max(2, entries))) + 16))
    drop = np.uint64(64 - width)

    def ask(batches):
        for block in blocks.each(batches):
            number, _, raw, at = blocks.opened(block)
            sets = [*shingle_sets(raw, at, rule.words), np.zeros(0, np.uint64)]
            yield exchange.requests(number, np.unique(np.concatenate(sets) >> drop), bits, width)

    replies = exchange.spread(table.mapInArrow(ask, exchange.REQUEST), bits, width)
    found = table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _prefixes(rule, bits, width), "doc long, n long, tokens binary, " + ", ".join(f"{c}{k} array<long>" for c in "tp" for k in range(ORDERS)))
    known = stage(found.join(classes.select("first"), F.col("doc") == F.col("first"), "left_semi"), "join-candidates", BLOCK_ROWS)
    links = _links(known, rule)
    placed = classes.join(links, F.col("first") == F.col("node"), "left").select(
        F.col("sig").alias("c_sig"), F.coalesce("component", "first").alias("component"))
    whole = listed.join(placed, F.when(F.col("doc_id").isNotNull(), F.col("sig")) == F.col("c_sig"), "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_representatives(docs: DataFrame, rule: Rule = STAGE_RULE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their component (or have no doc_id), with all columns, whatever their names.

    Rows that repeat the first's doc_id all stay: they are one document to this operator.
    """
    gone = shingle_components(docs, rule, doc_id, text).where("component_id < doc_id").select(F.col("doc_id").alias("gone"))
    rows = whole(docs, id=F.col(doc_id).cast("long"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
