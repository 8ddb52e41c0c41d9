"""Prefix trie of conversations by adaptive radix trees.

A turn is a fixed-width id: 16 bytes of the SHA-256 of its role and text and,
big-endian, the number of words of the text.  A conversation is the string of
its turns' ids, so sharing first turns means sharing a prefix.  Spark sorts
the conversations by (path, conv_id) into ranges; each task grows an adaptive
radix tree over its range (nodes of 4, 16, 48 or 256 slots, runs of single
children folded into a node's prefix) and walks it once.  Only byte depths
that end a turn are nodes of the trie.

A range holds a trie node whole unless the node lies on the path of the
range's first or last conversation.  Those nodes are handed on as two chains a
range, each with what the finished subtrees below have added up to, and the
next level grows a tree over the chains in the same way, until one range is
left.  A path shared by any number of conversations is thus spread over as
many ranges as its rows need.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import discard, stage

ID_BYTES, WIDTH = 16, 20  # a turn's id, with the word count
#: Chains that one task may merge; more are merged in ranges first.
CHAINS = 4096
_CHUNK = 1 << 20  # bytes of decimal ids in one row

_NODE = ("kind string, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends binary, path binary, sums binary")


class Node:
    """A radix tree node: the bytes that lead into it, what it holds, and children in a layout that grows with them."""

    __slots__ = ("prefix", "held", "keys", "slots", "size")

    def __init__(self, prefix: bytes):
        self.prefix, self.held, self.size = prefix, None, 0
        self.keys: bytearray | None = bytearray()  # 4 and 16: sorted key bytes; 48: key byte -> slot + 1; 256: none
        self.slots: list = []

    def child(self, key: int) -> Node | None:
        if self.keys is None:
            return self.slots[key]
        if len(self.keys) == 256:
            at = self.keys[key]
            return self.slots[at - 1] if at else None
        at = self.keys.find(key)
        return self.slots[at] if at >= 0 else None

    def put(self, key: int, node: Node) -> None:
        """Add or replace a child; a full layout becomes the next larger one."""
        if self.keys is None:
            self.size += self.slots[key] is None
            self.slots[key] = node
        elif len(self.keys) == 256:
            at = self.keys[key]
            if at:
                self.slots[at - 1] = node
            elif self.size < 48:
                self.slots.append(node)
                self.size += 1
                self.keys[key] = self.size
            else:
                whole: list = [None] * 256
                for k, c in self.children():
                    whole[k] = c
                self.keys, self.slots = None, whole
                self.put(key, node)
        else:
            at = self.keys.find(key)
            if at >= 0:
                self.slots[at] = node
            elif self.size < 16:  # the two small layouts: sorted key bytes beside the slots
                at = bisect_left(self.keys, key)
                self.keys.insert(at, key)
                self.slots.insert(at, node)
                self.size += 1
            else:
                index = bytearray(256)
                for i, k in enumerate(self.keys):
                    index[k] = i + 1
                self.keys = index
                self.put(key, node)

    def children(self) -> list[tuple[int, Node]]:
        """Children by ascending key byte."""
        if self.keys is None:
            return [(k, c) for k, c in enumerate(self.slots) if c is not None]
        if len(self.keys) == 256:
            return [(k, self.slots[at - 1]) for k, at in enumerate(self.keys) if at]
        return list(zip(self.keys, self.slots))


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def reach(node: Node, key: bytes) -> Node:
    """The node exactly ``key`` below ``node``, made if it is missing."""
    while key:
        below = node.child(key[0])
        if below is None:
            below = Node(key)
            node.put(key[0], below)
            return below
        n = _shared(below.prefix, key)
        if n < len(below.prefix):  # split the folded run
            upper = Node(below.prefix[:n])
            below.prefix = below.prefix[n:]
            upper.put(below.prefix[0], below)
            node.put(key[0], upper)
            below = upper
        node, key = below, key[n:]
    return node


class Walk:
    """The trie nodes of a radix tree in the order of a depth-first visit, and their sums.

    Sums of a node: conversations, smallest conv_id, children, leaves, saved
    tokens.  ``edge`` says which nodes lie on the path of the first (1) or the
    last key (2); with ``open_edges`` they keep what the finished nodes below
    add up to and are not finished themselves.
    """

    def __init__(self, root: Node, first: bytes, last: bytes, open_edges: bool):
        self.parent, self.words, self.depth, self.ends = [-1], [0], [0], [None]
        self.keys, self.edge = [hashlib.sha256().digest()], [3]
        self.sums = [list(root.held[:5]) if root.held else [0, _NONE, 0, 0, 0]]
        if root.held:
            self.ends[0] = root.held[5]
        todo = [(child, 0, b"", hashlib.sha256()) for _, child in reversed(root.children())]
        while todo:
            node, above, part, sha = todo.pop()
            part += node.prefix
            whole = len(part) // WIDTH * WIDTH
            for at in range(0, whole, WIDTH):
                turn, depth = part[at:at + WIDTH], self.depth[above] + 1
                sha = sha.copy()
                sha.update(turn)
                here = slice((depth - 1) * WIDTH, depth * WIDTH)
                self.edge.append(self.edge[above] & ((first[here] == turn) | (last[here] == turn) << 1))
                self.parent.append(above), self.words.append(int.from_bytes(turn[ID_BYTES:], "big")), self.depth.append(depth)
                self.keys.append(sha.digest()), self.sums.append([0, _NONE, 0, 0, 0]), self.ends.append(None)
                above = len(self.parent) - 1
            part = part[whole:]
            if node.held:
                self.sums[above], self.ends[above] = list(node.held[:5]), node.held[5]
            todo += [(child, above, part, sha) for _, child in reversed(node.children())]
        self.closed = [not (open_edges and e) for e in self.edge]
        for i in range(len(self.parent) - 1, -1, -1):
            if self.closed[i]:
                own = self.sums[i]
                own[3] += not own[2]
                own[4] += (own[0] - 1) * self.words[i]
                if i:
                    up = self.sums[self.parent[i]]
                    up[0] += own[0]
                    up[1] = min(up[1], own[1])
                    up[2] += 1
                    up[3] += own[3]
                    up[4] += own[4]

    def finished(self, own_ends: bool) -> pa.RecordBatch:
        """The finished nodes; a parent that is not finished is left to its key."""
        at = [i for i, c in enumerate(self.closed) if c]
        known = [i == 0 or self.closed[self.parent[i]] for i in at]
        rows = np.array([self.sums[i] for i in at], np.int64).reshape(-1, 5)
        over = [self.sums[self.parent[i]][1] if k and i else None for i, k in zip(at, known)]
        return _batch(len(at), kind="node", node=[self.keys[i] for i in at],
                      parent=[None if k else self.keys[self.parent[i]] for i, k in zip(at, known)],
                      conv_id=rows[:, 1], depth=[self.depth[i] for i in at], parent_conv_id=over, n_convs=rows[:, 0],
                      n_children=rows[:, 2], n_leaves=rows[:, 3], saved_tokens=rows[:, 4],
                      ends=[(self.ends[i] or _NO_ENDS) if own_ends else None for i in at])

    def chains(self, first: bytes, last: bytes) -> pa.RecordBatch:
        """The unfinished nodes: those on the first key's path, then the rest of the last key's."""
        paths, sums = [first], [np.array([s for s, e in zip(self.sums, self.edge) if e & 1], np.int64)]
        if last != first:
            paths.append(last)
            sums.append(np.array([s if e == 2 else [0, _NONE, 0, 0, 0] for s, e in zip(self.sums, self.edge) if e & 2], np.int64))
        return _batch(len(paths), kind="chain", path=paths, sums=[x.tobytes() for x in sums])


_NONE = (1 << 63) - 1
_NO_ENDS = hashlib.sha256(b"").digest()
_COLUMNS = [c.split() for c in _NODE.split(", ")]


def _batch(n: int, kind: str, **columns) -> pa.RecordBatch:
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    return pa.record_batch([pa.array([kind] * n if c == "kind" else columns.get(c, [None] * n), types[t]) for c, t in _COLUMNS],
                           names=[c for c, _ in _COLUMNS])


def _ends(path: bytes, conv_ids: list[int]) -> pa.RecordBatch:
    """The conversations that end at an unfinished node, in rows of bounded length."""
    step = _CHUNK // 20
    cuts = range(0, len(conv_ids), step)
    return _batch(len(cuts), kind="ends", node=[hashlib.sha256(path).digest()] * len(cuts), conv_id=[conv_ids[i] for i in cuts],
                  ends=[",".join(map(str, conv_ids[i:i + step])).encode() for i in cuts])


def _grow(batches):
    """One range of (path, conv_id), sorted: finished nodes, the two chains, and the ends of unfinished nodes."""
    root, first, path = Node(b""), None, b""
    on_path: list[tuple[bytes, list[int], Node]] = []  # nodes with ends, each a prefix of the next

    def close(below: bytes | None):
        while on_path and (below is None or not below.startswith(on_path[-1][0])):
            here, conv_ids, node = on_path.pop()
            node.held = [len(conv_ids), conv_ids[0], 0, 0, 0, None]
            if below is None or here == first:
                yield _ends(here, conv_ids)
            else:
                node.held[5] = hashlib.sha256(",".join(map(str, conv_ids)).encode()).digest()

    for batch in batches:
        for path, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if first is None:
                first = path
            if not on_path or on_path[-1][0] != path:
                yield from close(path)
                on_path.append((path, [], reach(root, path)))
            on_path[-1][1].append(conv_id)
    if first is not None:
        yield from close(None)
        walk = Walk(root, first, path, open_edges=True)
        yield walk.finished(own_ends=True)
        yield walk.chains(first, path)


def _merge(last_level: bool):
    """One range of chains, sorted by path: the nodes they finish and, but for the last level, two chains again."""

    def merge(batches):
        root, first, path = Node(b""), None, b""
        for batch in batches:
            for path, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first is None:
                    first = path
                node, at = root, 0
                for depth, (n, least, children, leaves, saved) in enumerate(np.frombuffer(sums, np.int64).reshape(-1, 5).tolist()):
                    if n or children:
                        node, at = reach(node, path[at:depth * WIDTH]), depth * WIDTH
                        was = node.held or [0, _NONE, 0, 0, 0, None]
                        node.held = [was[0] + n, min(was[1], least), was[2] + children, was[3] + leaves, was[4] + saved, None]
                reach(node, path[at:])
        if first is not None:
            walk = Walk(root, first, path, open_edges=not last_level)
            yield walk.finished(own_ends=False)
            if not last_level:
                yield walk.chains(first, path)

    return merge


def _digests(batches):
    """SHA-256 of each node's ends, whose rows come one after another."""
    node, sha = None, None
    for batch in batches:
        for own, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != node:
                if sha:
                    yield pa.record_batch([pa.array([node], pa.binary()), pa.array([sha.digest()], pa.binary())], names=["e_node", "e_ends"])
                node, sha = own, hashlib.sha256(part)
            else:
                sha.update(b",")
                sha.update(part)
    if sha:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([sha.digest()], pa.binary())], names=["e_node", "e_ends"])


def paths(conversations: DataFrame, group: int = 20, most_shared: int = 4, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """path, conv_id: every conversation rebuilt as the ids of its turns.

    Conversation c begins with the first h original turns of conversation
    c - c % ``group``, h = crc32(decimal c) % ``most_shared``, and goes on with its own turns
    after its first h.  Only ids leave the scan, not texts.
    """
    own_role, own_text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_count(own_text, F.lit(r"[^\x20\x09-\x0D]+"))
    digest = F.sha2(F.concat(F.octet_length(own_role).cast("string"), F.lit(":"), own_role, own_text), 256)
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.concat(F.substring(digest, 1, 2 * ID_BYTES), F.lpad(F.hex(words), 2 * (WIDTH - ID_BYTES), "0")).alias("id")).where("conv_id is not null")
    kind = turns.schema["turn"].dataType
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast(kind)).alias("turn"), F.col("id"))
    whole = stage(turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(order)), lambda t: t["id"]).alias("own")), "trie-turns")
    heads = whole.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("head_id"), F.slice("own", 1, most_shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int")
    joined = whole.join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("head_id"), "left").select(
        F.unhex(F.array_join(F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h),
                                      F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))), "")).alias("path"), "conv_id")
    out = stage(joined, "trie-paths")
    discard(whole)
    return out


def prefix_trie(conversations: DataFrame, chains: int = CHAINS, **columns) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per trie node.

    A node is a distinct sequence of first turns (role, text) of rebuilt
    conversations (see :func:`paths`), from the root without turns (depth 0,
    parent null).  conv_id is its smallest member.  Turns are ordered by turn,
    null first; turns of one conversation with the same number by their ids,
    and repeated rows are turns of their own.  A null role or text is empty;
    rows without conv_id take no part.  A conversation can be left without turns and is
    then a member of the root alone.  No conversation at all: no row, not even
    a root.  Other columns are not read.  Turns are told apart by 128 bits of
    SHA-256; a conversation's ids (20 bytes a turn) are one value.
    """
    rows = paths(conversations, **columns)
    grown = stage(rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_grow, _NODE), "trie-ranges")
    levels, upper = [grown], []
    while True:
        left = levels[-1].where("kind = 'chain'").select("path", "sums")
        n = left.count()
        few = n <= chains
        dealt = left.repartition(1) if few else left.repartitionByRange(max(2, n // chains), "path")
        levels.append(stage(dealt.sortWithinPartitions("path").mapInArrow(_merge(few), _NODE), "trie-level"))
        upper.append(levels[-1].where("kind = 'node'"))
        if few:
            break
    above = upper[0]
    for more in upper[1:]:
        above = above.unionByName(more)
    ends = (grown.where("kind = 'ends'").select("node", "ends", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
            .select("node", "ends").mapInArrow(_digests, "e_node binary, e_ends binary"))
    above = stage(above.drop("ends").join(ends, F.col("node") == F.col("e_node"), "left").withColumn(
        "ends", F.coalesce("e_ends", F.unhex(F.lit(_NO_ENDS.hex())))), "trie-above")
    nodes = grown.where("kind = 'node'").unionByName(above, allowMissingColumns=True)
    parents = above.select(F.col("node").alias("p_node"), F.col("conv_id").alias("p_conv_id"))
    waiting = nodes.where("parent is not null").join(parents, F.col("parent") == F.col("p_node")).withColumn("parent_conv_id", F.col("p_conv_id"))
    done = [df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.lower(F.hex("ends")).alias("ends_sha256")) for df in (nodes.where("parent is null"), waiting)]
    out = stage(done[0].unionByName(done[1]), "trie-nodes")
    discard(rows, *levels, above)
    return out
