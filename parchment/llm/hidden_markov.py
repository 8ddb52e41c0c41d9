"""Language-model scoring with a hidden Markov model over words.

A text is its words (A-Z lower-cased) and one end token.  Latent states emit
tokens; Baum-Welch trains them, each round one pass over all training texts:
every task runs the scaled forward-backward recursion over its own texts (in
pieces of ``PIECE`` tokens) and sends expected counts, which Spark adds up by
key.

The first rounds tie the emissions of words that share a class (a hash of the
word, ``CLASSES`` of them), so that the parameters have a fixed size and go to
the tasks as they are.  The last round counts per word: a table of every
training word with its count and its expected count in each state, as long as
the vocabulary.  It never leaves Spark: texts are kept in blocks with a
dictionary of their own words, and a join on the word deals each block the
rows of its dictionary.  A state's probability of a word is the smoothed
unigram share with the count replaced by the state's expected count, scaled
to all tokens, so states differ from the unigram only by what they learned.

The probability of a text is exact: the product of the forward recursion's
scales over all of its tokens.  All texts of a block advance together, one
token a step, longest first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import discard, id_array, ids, mix, stage, utf8

STATES = 5
CLASSES = 1 << 16
ROUNDS = 3  # with tied emissions; one more counts per word
STAY = 0.9  # the first guess of a state's probability of staying
#: Training reads a text in pieces of so many tokens, each from the first-state probabilities; scoring never cuts.
PIECE = 512
TRAIN_TOKENS = 1 << 19  # tokens of pieces or texts that advance together, if no single text has more
BLOCK_BYTES = 8 << 20
#: Tokens whose state probabilities are held at once; longer stretches are computed again from kept marks.
HELD_TOKENS = 1 << 21
ROWS = 1 << 15  # dictionary rows handed to Spark, or by Spark, at once (a block is one row of its group)
END = ""  # the end token's entry in a dictionary: no word is empty

_BLOCK = "block long, ids binary, sizes binary, learn binary, tokens binary, classes binary, words array<string>"


def _classes(words: pa.Array) -> np.ndarray:
    """The class of each distinct word: a hash of its bytes; class 0 is the end token's own."""
    out, step = [np.zeros(0, np.int32)], 1 << 16
    for first in range(0, len(words), step):
        out.append(_some_classes(*utf8(words.slice(first, step))))
    return np.concatenate(out)


def _some_classes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    size = np.diff(at)
    place = np.arange(len(raw)) - np.repeat(at[:-1], size)
    odd = np.uint64(0x9E3779B97F4A7C15) * (np.arange(int(size.max(initial=0)) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    parts = mix((raw.astype(np.uint64) + np.uint64(1)) * odd[place])
    whole = np.concatenate([[np.uint64(0)], np.cumsum(parts, dtype=np.uint64)])
    return 1 + (mix(whole[at[1:]] - whole[at[:-1]]) % np.uint64(CLASSES - 1)).astype(np.int32)


def tokens(texts) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts one after another, and words a text."""
    raw, at = utf8(texts)
    lower = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    lists = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(lower)))
    flat, cuts = lists.flatten(), lists.offsets.to_numpy()
    solid = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(solid.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return flat.filter(solid).dictionary_encode(), np.diff(before[cuts - cuts[0]])


def numbered(parts: list[tuple[pa.DictionaryArray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token numbers of the parts' texts one after another, tokens a text, and one dictionary; the end token comes after its last entry."""
    coded = pa.chunked_array([p for p, _ in parts]).unify_dictionaries()
    words, n_words = coded.chunk(0).dictionary, np.concatenate([n for _, n in parts])
    flat = np.full(len(coded) + len(n_words), len(words), np.int32)
    solid = np.ones(len(flat), bool)
    solid[np.cumsum(n_words + 1) - 1] = False
    flat[solid] = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks])
    return flat, n_words + 1, words


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of texts as numbers into the block's own dictionary, with each entry's class."""

    def cut(batches):
        press, number = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId() << 32
        parts, own, learn, size = [], [], [], 0

        def out():
            flat, sizes, words = numbered(parts)
            classes = np.concatenate([_classes(words), np.zeros(1, np.int32)]).astype(np.uint16)
            entries = pa.concat_arrays([words.cast(pa.string()), pa.array([END])])
            return pa.record_batch([
                pa.array([number], pa.int64()), pa.array([np.concatenate(own).tobytes()], pa.binary()),
                pa.array([sizes.astype(np.int64).tobytes()], pa.binary()),
                pa.array([np.concatenate(learn).astype(np.uint8).tobytes()], pa.binary()),
                pa.array([press(flat.tobytes())], pa.binary()), pa.array([classes.tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries)],
                names=["block", "ids", "sizes", "learn", "tokens", "classes", "words"])

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                done = sizes[first - 1] if first else 0
                last = min(batch.num_rows, max(first + 1, int(np.searchsorted(sizes, done + block_bytes - size, "right"))))
                here = batch.slice(first, last - first)
                parts.append(tokens(here.column(1)))  # texts are let go as they come
                own.append(ids(here.column(0))), learn.append(here.column(2).to_numpy(zero_copy_only=False))
                size, first = size + int(sizes[last - 1] - done), last
                if size >= block_bytes or first < batch.num_rows:
                    yield out()
                    parts, own, learn, size, number = [], [], [], 0, number + 1
        if parts:
            yield out()

    return stage(docs.mapInArrow(cut, _BLOCK), "hmm-blocks")


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(row["sizes"], np.int64)
    flat = zstandard.ZstdDecompressor().decompress(row["tokens"], max_output_size=4 * int(sizes.sum()) + 1)
    return np.frombuffer(flat, np.int32), sizes


class Steps:
    """The tokens of many texts by step: at step t stand the t-th tokens of the texts that have one, longest text first."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[self.order] = np.arange(len(sizes))
        self.n_steps = int(sizes.max(initial=0))
        active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(self.n_steps), "right")
        self.at = np.concatenate([[0], np.cumsum(active)])
        t = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.symbols = np.empty(len(flat), flat.dtype)
        self.symbols[self.at[t] + np.repeat(rank, sizes)] = flat

    def pieces(self) -> list[tuple[int, int]]:
        """Runs of steps of ``HELD_TOKENS`` tokens or so."""
        cuts = np.searchsorted(self.at, np.arange(HELD_TOKENS, len(self.symbols), HELD_TOKENS))
        edges = np.unique(np.concatenate([[0], cuts, [self.n_steps]]))
        return list(zip(edges[:-1], edges[1:]))


@dataclass(frozen=True)
class Chain:
    """First-state probabilities and transitions."""

    start: np.ndarray
    move: np.ndarray

    def forward(self, emit: np.ndarray, steps: Steps, first: int, last: int, before: np.ndarray | None, held: bool):
        """State probabilities after each step of [first, last) (only the last step's if not ``held``) and the scales."""
        lo = steps.at[first]
        n = int(steps.at[last] - lo)
        start, move = self.start.astype(emit.dtype), self.move.astype(emit.dtype)
        one = np.ones(len(start), emit.dtype)
        all_, scale, a = np.empty((n if held else 0, len(start)), emit.dtype), np.empty(n, emit.dtype), before
        for t in range(first, last):
            i, j = steps.at[t], steps.at[t + 1]
            a = (start if a is None else a[:j - i] @ move) * emit[steps.symbols[i:j]]
            s = a @ one
            a /= s[:, None]
            scale[i - lo:j - lo] = s
            if held:
                all_[i - lo:j - lo] = a
        return all_, scale, a

    def log10(self, emit: np.ndarray, steps: Steps) -> np.ndarray:
        """log10 probability of each text, in the texts' own order."""
        total, a = np.zeros(len(steps.order)), None
        for first, last in steps.pieces():
            _, scale, a = self.forward(emit, steps, first, last, a, held=False)
            rank = np.arange(steps.at[first], steps.at[last]) - np.repeat(steps.at[first:last], np.diff(steps.at[first:last + 1]))
            total += np.bincount(rank, np.log10(scale), minlength=len(total))
        out = np.empty(len(total))
        out[steps.order] = total
        return out

    def expect(self, emit: np.ndarray, steps: Steps, key: np.ndarray, n_keys: int):
        """Expected counts: first states, moves, and states by ``key[symbol]`` (n_keys, states)."""
        k = len(self.start)
        first_state, moves, by_key = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_keys))
        pieces, marks, a = steps.pieces(), [], None
        for first, last in pieces:
            marks.append(a)
            if last < steps.n_steps:
                _, _, a = self.forward(emit, steps, first, last, a, held=False)
        back_move, back = self.move.T.astype(emit.dtype), np.zeros((0, k), emit.dtype)  # emission times later evidence of the step after
        for (first, last), mark in zip(reversed(pieces), reversed(marks)):
            alpha, scale, _ = self.forward(emit, steps, first, last, mark, held=True)
            lo = steps.at[first]
            for t in range(last - 1, first - 1, -1):
                i, j = steps.at[t] - lo, steps.at[t + 1] - lo
                beta = np.ones((j - i, k), emit.dtype)
                beta[:len(back)] = back @ back_move
                moves += alpha[i:i + len(back)].T @ back
                alpha[i:j] *= beta
                back = beta * (emit[steps.symbols[lo + i:lo + j]] / scale[i:j, None])
            if first == 0:
                first_state += alpha[:steps.at[1]].sum(0)
            own = key[steps.symbols[lo:steps.at[last]]]
            for s in range(k):
                by_key[s] += np.bincount(own, alpha[:, s], minlength=n_keys)
        return first_state, moves * self.move, by_key.T


def log10_texts(chain: Chain, emit: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each text; texts of like length advance together, some at a time."""
    order = np.argsort(-sizes, kind="stable")
    ends, starts = np.cumsum(sizes), np.cumsum(sizes) - sizes
    out, first, total = np.zeros(len(sizes)), 0, np.concatenate([[0], np.cumsum(sizes[order])])
    while first < len(order):
        last = max(first + 1, int(np.searchsorted(total, total[first] + TRAIN_TOKENS, "right")) - 1)
        some = order[first:last]
        here = np.concatenate([flat[starts[i]:ends[i]] for i in some])
        out[some] = chain.log10(emit, Steps(here, sizes[some]))
        first = last
    return out


def _shares(counts: np.ndarray, smooth: float) -> np.ndarray:
    return (counts + smooth) / (counts + smooth).sum(-1, keepdims=True)


def _guess(states: int) -> tuple[Chain, np.ndarray]:
    """Where training begins: sticky states whose emissions differ by a hash of class and state."""
    move = np.full((states, states), (1 - STAY) / max(1, states - 1)) + np.eye(states) * (STAY - (1 - STAY) / max(1, states - 1))
    noise = mix(np.arange(CLASSES * states, dtype=np.uint64) + np.uint64(1)).astype(float) / 2.0**64
    return Chain(np.full(states, 1 / states), move / move.sum(1, keepdims=True)), 0.5 + noise.reshape(CLASSES, states)


def _learned(block: dict, symbol: np.ndarray | None = None):
    """The training texts of a block in pieces, some at a time, as the block's own token numbers or what ``symbol`` makes of them."""
    flat, sizes = _opened(block)
    learn = np.frombuffer(block["learn"], np.uint8).astype(bool)
    flat, sizes = flat[np.repeat(learn, sizes)], sizes[learn]
    n = -(-sizes // PIECE)
    pieces = np.full(int(n.sum()), PIECE)
    pieces[np.cumsum(n) - 1] = sizes - PIECE * (n - 1)
    ends = np.concatenate([[0], np.cumsum(pieces)])
    first = 0
    while first < len(pieces):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + TRAIN_TOKENS, "right")) - 1)
        here = flat[ends[first]:ends[last]]
        yield Steps(here if symbol is None else symbol[here], pieces[first:last])
        first = last


def _tied_round(blocks: DataFrame, chain: Chain, emit: np.ndarray):
    """One round over all training texts: first states, moves and (classes, states) expected counts."""
    k, part = len(chain.start), emit.astype(np.float32)
    names = [f"s{i}" for i in range(k)]

    def count(batches):
        moves, by_class = np.zeros((k + 1, k)), np.zeros((CLASSES, k))
        for batch in batches:
            for row in batch.to_pylist():
                classes = np.frombuffer(row["classes"], np.uint16)
                for steps in _learned(row, classes):
                    a, b, c = chain.expect(part, steps, np.arange(CLASSES), CLASSES)
                    moves[0] += a
                    moves[1:] += b
                    by_class += c
        seen = np.flatnonzero(by_class.any(1))
        rows = np.concatenate([by_class[seen], moves])
        yield pa.record_batch([pa.array(np.concatenate([seen, CLASSES + np.arange(k + 1)]).astype(np.int32)),
                               *(pa.array(rows[:, i]) for i in range(k))], names=["key", *names])

    sums = stage(blocks.select("sizes", "learn", "tokens", "classes")
                 .mapInArrow(count, "key int, " + ", ".join(f"{n} double" for n in names))
                 .groupBy("key").agg(*(F.sum(n).alias(n) for n in names)), "hmm-counts", 1)
    kept, sums = sums, sums.toArrow()  # CLASSES + states + 1 rows at most
    discard(kept)
    full = np.zeros((CLASSES + k + 1, k))
    full[sums["key"].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], 1) if sums.num_rows else 0
    return full[CLASSES], full[CLASSES + 1:], full[:CLASSES]


def train(blocks: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Chain, np.ndarray]:
    """The chain and (classes, states) emissions after ``rounds`` passes over the training texts."""
    chain, emit = _guess(states)
    for _ in range(rounds):
        first, moves, by_class = _tied_round(blocks, chain, emit)
        all_, state = by_class.sum(1, keepdims=True), by_class.sum(0)
        if not state.sum():
            break  # nothing to learn from
        # a class that a state has not met keeps a small share of its overall probability there
        emit = (by_class + 0.01 * (all_ + 0.01) * _shares(state, 1e-6)) / (state + 1e-6)
        chain = Chain(_shares(first, 0.01), _shares(moves, 0.01))
    return chain, emit


def vocabulary(blocks: DataFrame, chain: Chain, emit: np.ndarray) -> DataFrame:
    """word, c (its count in training texts) and p0.. (its states' shares of c), one row per training word.

    A share is rounded to 1/255, seven to a long; what the model adds up over
    all words are the rounded counts, so its probabilities still sum to one.
    """
    k, part = len(chain.start), emit.astype(np.float32)
    names = [f"s{i}" for i in range(k)]

    def count(batches):
        for batch in batches:
            words_of = batch.column(batch.schema.get_field_index("words"))
            for i, row in enumerate(batch.drop_columns(["words"]).to_pylist()):
                classes = np.frombuffer(row["classes"], np.uint16)
                emission, every = part[classes], np.arange(len(classes))
                c, by_word = np.zeros(len(classes), np.int64), np.zeros((len(classes), k))
                for steps in _learned(row):
                    c += np.bincount(steps.symbols, minlength=len(classes))
                    by_word += chain.expect(emission, steps, every, len(classes))[2]
                entries = words_of.slice(i, 1).flatten()
                for seen in np.array_split(np.flatnonzero(c), 1 + len(c) // ROWS):
                    yield pa.record_batch([entries.take(pa.array(seen)), pa.array(c[seen]), *(pa.array(by_word[seen, s]) for s in range(k))],
                                          names=["word", "c", *names])
                del entries, by_word
                pa.default_memory_pool().release_unused()

    rows = blocks.select("sizes", "learn", "tokens", "classes", "words").mapInArrow(
        count, "word string, c long, " + ", ".join(f"{n} double" for n in names))
    sums = rows.groupBy("word").agg(F.sum("c").alias("c"), *(F.sum(n).alias(n) for n in names))
    packed = [reduce(Column.bitwiseOR, [F.shiftleft(F.round(255 * F.col(n) / F.col("c")).cast("long"), 8 * i) for i, n in enumerate(names[j:j + 7])])
              .alias(f"p{j // 7}") for j in range(0, k, 7)]
    return stage(sums.select("word", "c", *packed), "hmm-vocabulary", 1)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    Texts whose crc32(doc_id as text) mod 5 is not 1 train the model; a row
    without an id is scored but neither learned from nor held out.  Null text
    is an empty text: one end token.  base_score is the smoothed unigram's
    log10 probability, score the hidden Markov model's.  Repeated rows are
    learned from and scored each; without any training text every token has
    probability 1.  An empty table gives an empty result; other columns are
    not read.  A text's token numbers (4 bytes a token) are held by one task.
    """
    own = F.col(doc_id).cast("long")
    held = F.crc32(own.cast("string").cast("binary")) % 5 == 1
    blocks = _blocks(docs.select(own.alias("doc_id"), F.col(text).alias("text"), F.coalesce(~held, F.lit(False)).alias("learn")), block_bytes)
    chain, emit = train(blocks, states, rounds)
    words = vocabulary(blocks, chain, emit)
    names, packed = [f"s{i}" for i in range(states)], [f"p{j // 7}" for j in range(0, states, 7)]
    count = [F.col("c") * F.shiftright(f"p{i // 7}", 8 * (i % 7)).bitwiseAND(255) for i in range(states)]
    sums = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                     *(F.coalesce(F.sum(x) / 255, F.lit(0.0)).alias(n) for x, n in zip(count, names))).first()
    n_all, whole = int(sums["n"]), float(sums["n"] + 0.5 * (sums["v"] + 1))
    scale = np.array([n_all / sums[s] if sums[s] else 0.0 for s in names])
    # a state without any expected count emits like the unigram
    empty = np.array([not sums[s] for s in names])

    def finish(texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        row = texts.slice(0, 1).to_pylist()[0]
        flat, sizes = _opened(row)
        size = len(row["classes"]) // 2
        c, by_state = np.zeros(size), np.zeros((size, states))
        at = dictionary["place"].to_numpy()
        c[at] = dictionary["c"].to_numpy()
        for i in range(states):
            by_state[at, i] = c[at] * ((dictionary[f"p{i // 7}"].to_numpy() >> 8 * (i % 7)) & 255) / 255
        emission = (by_state * scale + np.where(empty, c[:, None], 0) + 0.5) / whole
        of = np.repeat(np.arange(len(sizes)), sizes)
        return pa.table({
            "doc_id": id_array(np.frombuffer(row["ids"], np.int64)), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.bincount(of[c[flat] > 0], minlength=len(sizes)).astype(np.int64)),
            "base_score": pa.array(np.bincount(of, np.log10((c + 0.5) / whole)[flat], minlength=len(sizes))),
            "score": pa.array(log10_texts(chain, emission, flat, sizes))})

    entries = blocks.select(F.col("block").alias("of_block"), F.posexplode("words").alias("place", "word"))
    known = entries.join(words, "word").select("of_block", "place", "c", *packed)
    scored = (blocks.select("block", "ids", "sizes", "tokens", "classes").groupBy("block")
              .cogroup(known.groupBy("of_block")).applyInArrow(
        finish, "doc_id long, n_tokens long, n_known long, base_score double, score double"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    out = stage(scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                              F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score"), "hmm-scores", ROWS)
    discard(blocks, words)
    return out
