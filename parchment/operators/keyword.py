"""Keyword scores by cover density over a stored, term-ordered index of posting blocks.

A query is an alternative of clauses; a clause is a set of items that must all
occur and of items that must not; an item is a word or a phrase (words at
fixed distances).  Plain text is one clause of its distinct content words.
Score of a (query, chunk) pair and a clause: each minimal cover - the shortest
span ending at an occurrence that holds all items, counted once per distinct
start - adds ``0.1 / (1 + noise)``, noise being the positions inside the span at
which no item stands (a phrase stands at its first word).  With one item every
occurrence counts 0.1; clauses add up.  (Clarke, Cormack & Tudhope's cover
density ranking with the default lexeme weight.)

Positions count every token of the chunk, stop words included; stop words in
a query are dropped, in a phrase they keep their distance.

The index holds one row per posting block: a term, its document frequency,
and up to about ``BLOCK_POSTINGS`` chunks with their positions.  A term with
many chunks has a power of two of blocks, and a chunk's block follows from its
id (a hash) or number, so a candidate knows which block of any other term to look at.
Blocks lie ordered by term in folders by term hash: a query reads the folders
and row groups of its own terms.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from parchment.constants import COVER_WEIGHT, STOPWORDS
from parchment.functions.text import content_tokens, tokens
from parchment.functions.tokens import split_tokens, utf8
from parchment.operators.joins import bounded_broadcast
from parchment.session import materialize

BLOCK_POSTINGS = 128
_STRIPES = 8  # stretches of neighbouring numbers that a block takes up
RUN_CHUNKS = 8192
_FOLDERS = 32
MAX_ITEMS = 200_000
MAX_FREQUENT = 500_000  # words with more than BLOCK_POSTINGS chunks that may be broadcast, about 100 bytes each
MAX_WANTED = 1_000_000  # (word, block, chunk) rows of three numbers and a word that may be broadcast
PART_POSTINGS = 1 << 18  # postings that a task matches at a time, where more are wanted
_NEIGHBOURS = 1024  # numbers that go to one part together
_MAX_PARTITIONS = 8192
_BASE = 1 << 30  # added to positions, so that one before a chunk's first is still the chunk's
_PIECE = r'-?"[^"]*"|[^\s"]+'
_ITEM_FIELDS = (("clause", T.IntegerType()), ("item", T.IntegerType()), ("n_items", T.IntegerType()), ("n_terms", T.IntegerType()),
                ("negative", T.BooleanType()), ("offset", T.IntegerType()), ("n_words", T.IntegerType()), ("term", T.StringType()))


def cover_density(occ: F.Column, n_terms: F.Column) -> F.Column:
    """Fold over ``occ`` (array<struct<pos,term_idx>> sorted by pos) -> score (double)."""
    m = F.size(occ)
    zero = F.struct(
        F.array_repeat(F.lit(-1), n_terms).alias("last"),
        F.lit(-1).alias("prev_start"),
        F.lit(0.0).cast("double").alias("score"))

    def step(acc, e):
        o = F.element_at(occ, e + 1)
        last = F.transform(acc["last"], lambda x, i: F.when(i == o["term_idx"], e).otherwise(x))
        start = F.array_min(last)
        emit = (start >= 0) & (start > acc["prev_start"])
        s_pos = F.element_at(occ, start + 1)["pos"]
        noise = (o["pos"] - s_pos) - (e - start)
        return F.struct(
            last.alias("last"),
            F.when(emit, start).otherwise(acc["prev_start"]).alias("prev_start"),
            F.when(emit, acc["score"] + F.lit(COVER_WEIGHT) / (F.lit(1.0) + noise.cast("double")))
             .otherwise(acc["score"]).alias("score"))

    return F.aggregate(F.sequence(F.lit(0), m - 1), zero, step, lambda acc: acc["score"])


# ---------------------------------------------------------------- index
def posting_key(index: DataFrame) -> str:
    """What names a chunk in the postings: its number, where the index has one (8 bytes instead of a long id)."""
    return "chunk_no" if "chunk_no" in index.columns else "chunk_id"


def build_postings(index: DataFrame) -> DataFrame:
    """The posting blocks of ``index`` (chunk_id, chunk_text), written once: folder, term, df, n_blocks, width, block, postings.

    ``postings.chunk_id`` is the chunk's ``posting_key``.  A task turns some
    chunks at a time into one run of postings per term, so a row moved holds
    many postings; runs are written once, counted, cut into blocks, and moved
    once, to where blocks are put together.  On the way postings are packed (``ids``,
    ``places``), a few bytes each, and blocks of numbered chunks follow from stretches of
    ``width`` numbers, so that a run is cut into few pieces.  A folder is written by a few tasks, each of
    which orders its blocks by term.
    """
    chunks = index.select(F.col(posting_key(index)).alias("chunk_id"), F.lower("chunk_text").alias("text"))
    key = chunks.schema["chunk_id"]
    numbered = isinstance(key.dataType, T.LongType)
    span = 0
    if numbered:  # a chunk without a number is found by no query
        chunks = chunks.where("chunk_id IS NOT NULL")
        span = (chunks.agg(F.max("chunk_id")).collect()[0][0] or 0) + 1
    packed = [T.StructField("ids", T.BinaryType() if numbered else T.ArrayType(key.dataType)), T.StructField("places", T.BinaryType())]
    term, n = T.StructField("term", T.StringType()), T.StructField("n", T.LongType())
    runs = materialize(chunks.mapInArrow(lambda batches: _runs(_worded(batches)), T.StructType([term, n, *packed])), "posting-runs")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("df") / F.lit(BLOCK_POSTINGS)))).cast("int")
    # the other terms have one block, which is all of their postings, and here no df
    n_blocks = F.when(F.col("df").isNull(), F.lit(1)).otherwise(F.pow(F.lit(2), bits).cast("int"))
    width = F.greatest(F.lit(1), F.floor(F.lit(float(span)) / (F.col("n_blocks") * _STRIPES))).cast("long")
    layout = lambda rows: (rows.withColumn("n_blocks", n_blocks)
                           .withColumn("width", width if numbered else F.lit(None).cast("long")))
    # written: its size is looked at before it is joined, and all runs were counted for it
    frequent = materialize(runs.groupBy("term").agg(F.sum("n").alias("df")).where(F.col("df") > BLOCK_POSTINGS), "posting-terms")
    placed = layout(runs.join(bounded_broadcast(frequent, MAX_FREQUENT), "term", "left"))
    if not numbered:
        placed = placed.withColumn("blocks", F.transform("ids", lambda x: _block_of(x, "n_blocks", "width", key.dataType)))
    place = [T.StructField("df", T.LongType()), T.StructField("n_blocks", T.IntegerType()), T.StructField("width", T.LongType()),
             T.StructField("block", T.IntegerType())]
    # what follows from term and df is not moved
    cut = placed.mapInArrow(_cut, T.StructType([term, *place, *packed])).drop("n_blocks", "width")
    parts = -(-int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // _FOLDERS)
    order = ["folder", "term", "block"]
    folder = (F.crc32("term") % _FOLDERS).cast("int")
    moved = layout(cut.repartition(folder, F.pmod(F.xxhash64("term", "block"), F.lit(parts))))
    moved = (moved.select("term", "df", "n_blocks", "width", "block", "ids", "places", folder.alias("folder"))
             .sortWithinPartitions(*order))
    posting = T.ArrayType(T.StructType([key, T.StructField("positions", T.ArrayType(T.IntegerType()))]))
    gathered = moved.mapInArrow(_gathered, T.StructType([term, *place, T.StructField("postings", posting), T.StructField("folder", T.IntegerType())]))
    if chunks.groupBy("chunk_id").count().where("count > 1").limit(1).count():  # rows of one chunk share a posting
        gathered = gathered.withColumn("postings", _merged("postings"))
    return materialize(gathered.sortWithinPartitions(*order), "postings", partition_by=("folder",))


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Row i's numbers, from ``ends[i]`` to ``ends[i + 1]``, as bytes: seven bits each, the eighth says that more follow."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >= np.uint64(1 << bits)
    place = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(place[-1], np.uint8)
    for k in range(size.max(initial=0)):
        some = np.flatnonzero(size > k)
        data[place[some] + k] = (values[some] >> np.uint64(7 * k)) & np.uint64(127) | (size[some] > k + 1).astype(np.uint64) << np.uint64(7)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(place[ends].astype(np.int32)), pa.py_buffer(data)])


def _unpacked(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of :func:`_packed` and their ``ends``."""
    rows = rows.cast(pa.binary())
    at = np.frombuffer(rows.buffers()[1], np.int32, len(rows) + 1, rows.offset * 4)
    data = np.frombuffer(rows.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])[:len(last)]
    values = np.zeros(len(last), np.uint64)
    for k in range((last - first).max(initial=-1) + 1):
        some = np.flatnonzero(last - first >= k)
        values[some] |= (data[first[some] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    return values, np.searchsorted(last, at - at[0])


def _pack(ids: pa.Array, sizes: np.ndarray, positions: np.ndarray, run: np.ndarray) -> list[pa.Array]:
    """(ids, places) of postings ``run[i]`` to ``run[i + 1]`` for every row i; ``sizes`` positions each, ascending.

    Numbers and positions are differences from those before them, modulo 2^64;
    the lowest bit of a place says that a posting begins.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    begins = np.zeros(len(positions), np.uint64)
    begins[ends[:-1]] = 1
    gap = np.diff(positions, prepend=0)
    gap[ends[:-1]] = positions[ends[:-1]]
    places = _packed(gap.astype(np.uint64) << np.uint64(1) | begins, ends[run])
    if not pa.types.is_int64(ids.type):
        return [pa.ListArray.from_arrays(pa.array(run, pa.int32()), ids), places]
    numbers = ids.to_numpy().astype(np.uint64)
    step = np.diff(numbers, prepend=np.uint64(0))
    step[run[:-1]] = numbers[run[:-1]]
    return [_packed(step, run), places]


def _unpack(rows: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """ids, sizes, positions and ``run`` that :func:`_pack` was given; no row is without a posting."""
    places, _ = _unpacked(rows.column("places"))
    begin = np.flatnonzero(places & np.uint64(1))
    positions = _sums((places >> np.uint64(1)).astype(np.int64), begin)
    ids, sizes = rows.column("ids"), np.diff(begin, append=len(places))
    if pa.types.is_list(ids.type):
        return ids.flatten(), sizes, positions, np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
    steps, run = _unpacked(ids)
    return pa.array(_sums(steps.astype(np.int64), run[:-1])), sizes, positions, run


def _sums(steps: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the steps up to each, from the last of ``begin`` on."""
    total = np.cumsum(steps)
    return total - np.repeat(total[begin] - steps[begin], np.diff(begin, append=len(steps)))


def _whole(batches, rows: int):
    """The batches put together to at least ``rows`` rows each, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _worded(batches):
    """The tokens of each text, as the function ``tokens`` has them."""
    for batch in batches:
        words, n = split_tokens(*utf8(batch.column("text")))
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("chunk_id"), pa.ListArray.from_arrays(ends, words)], ["chunk_id", "words"])


def _runs(batches):
    """(term, n, ids, places) for every term of some chunks."""
    for batch in _whole(batches, RUN_CHUNKS):
        size = -(-batch.num_rows // max(1, batch.num_rows // RUN_CHUNKS))  # runs of one size
        for at in range(0, batch.num_rows, max(1, size)):
            some = batch.slice(at, size)
            words = some.column("words")
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = words.flatten().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            if not len(code):
                continue
            row, first = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.argsort(code, kind="stable")  # by term, then chunk, then position
            code, row, position = code[order], row[order], (np.arange(len(order)) - first)[order]
            new_term = np.diff(code, prepend=-1) != 0
            posting = np.flatnonzero(new_term | (np.diff(row, prepend=-1) != 0))
            run = np.append(np.flatnonzero(new_term[posting]), len(posting))
            held = _pack(some.column("chunk_id").take(pa.array(row[posting])), np.diff(posting, append=len(code)), position, run)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(code[posting][run[:-1]])), pa.array(np.diff(run), pa.int64()), *held], ["term", "n", "ids", "places"])


def _cut(batches):
    """Runs cut by the block of each posting: that of its number, or ``blocks``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, sizes, positions, run = _unpack(batch)
        row = np.repeat(np.arange(batch.num_rows), np.diff(run))
        if "blocks" in batch.schema.names:
            blocks = batch.column("blocks").flatten().to_numpy()
        else:
            blocks = ids.to_numpy() // batch.column("width").to_numpy()[row] % batch.column("n_blocks").to_numpy()[row]
        order = np.lexsort((blocks, row))
        row, blocks = row[order], blocks[order]
        run = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
        sizes, positions = _reordered(sizes, positions, order)
        whose = pa.array(row[run])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(whose) for c in ("term", "df", "n_blocks", "width")], pa.array(blocks[run], pa.int32()),
             *_pack(ids.take(pa.array(order)), sizes, positions, np.append(run, len(row)))],
            ["term", "df", "n_blocks", "width", "block", "ids", "places"])


def _reordered(sizes: np.ndarray, positions: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and positions of the postings ``order``."""
    first, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    return sizes, positions[_slices(first, sizes)]


def _slices(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[i]`` and the ``sizes[i] - 1`` numbers that follow, for every i."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _gathered(batches):
    """Blocks put together from neighbouring rows; a batch's last block waits for the next batch."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            rows = batch if rest is None else pa.concat_batches([rest, batch])
            start = _block_starts(rows)
            if len(start) > 1:
                yield _blocks(rows.slice(0, start[-1]), start[:-1])
            rest = rows.slice(start[-1])
    if rest is not None:
        yield _blocks(rest, np.array([0]))


def _block_starts(rows: pa.RecordBatch) -> np.ndarray:
    """The rows at which another term or block begins."""
    term = rows.column("term").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    block = rows.column("block").to_numpy(zero_copy_only=False)
    return np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))


def _blocks(rows: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
    ids, sizes, positions, run = _unpack(rows)
    places = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(positions, pa.int32()))
    held = pa.StructArray.from_arrays([ids, places], ["chunk_id", "positions"])
    ends = np.append(run[start], run[-1])
    first = rows.select(["term", "df", "n_blocks", "width", "block", "folder"]).take(pa.array(start))
    df = pc.coalesce(first.column("df"), pa.array(np.diff(ends), pa.int64()))
    postings = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)
    return pa.RecordBatch.from_arrays(
        [first.column("term"), df, *first.columns[2:5], postings, first.column("folder")],
        ["term", "df", "n_blocks", "width", "block", "postings", "folder"])


def _merged(postings: str) -> F.Column:
    """One posting a chunk, with the positions of all its rows."""
    return F.transform(F.array_distinct(f"{postings}.chunk_id"), lambda c: F.struct(c.alias("chunk_id"), F.sort_array(F.flatten(
        F.transform(F.filter(postings, lambda x: x["chunk_id"].eqNullSafe(c)), lambda x: x["positions"]))).alias("positions")))


def _block_of(chunk_id: F.Column, n_blocks: str, width: str, key: T.DataType) -> F.Column:
    """Ids are hashed.  Of numbers, ``width`` neighbours share a block, so a run's postings are cut into few pieces;
    blocks take turns, so a term that stands in one part of the chunks has several there."""
    floor = F.call_function("div", chunk_id - F.pmod(chunk_id, F.col(width)), F.col(width))
    turn = floor if isinstance(key, T.LongType) else F.xxhash64(chunk_id)
    return F.pmod(turn, F.col(n_blocks)).cast("int")


# ---------------------------------------------------------------- queries
def plain_items(query_id, words: list[str]) -> list[tuple]:
    """One clause of distinct words."""
    return [(query_id, 0, i, len(words), len(words), False, 0, 1, w) for i, w in enumerate(words)]


def web_items(query_id, pieces: list) -> list[tuple]:
    """Clauses of a web-style query: ``"a phrase"``, ``or`` between alternatives, ``-word`` and ``-"a phrase"`` excluded.

    ``pieces`` are rows (raw, words): the query cut at blanks and quotes, with
    the tokens of each piece.  A clause without a positive item matches nothing.
    """
    clauses: list[list[tuple[bool, tuple]]] = [[]]
    for raw, words in pieces:
        if raw.lower() == "or":
            clauses.append([])
            continue
        kept = [(i, w) for i, w in enumerate(words) if w not in STOPWORDS]
        if kept:  # distances count from the first word that is kept
            item = (raw.startswith("-"), tuple((i - kept[0][0], w) for i, w in kept))
            if item not in clauses[-1]:
                clauses[-1].append(item)
    out = []
    for c, items in enumerate(dict.fromkeys(tuple(x) for x in clauses)):
        positive = [x for x in items if not x[0]]
        n_terms = sum(len(words) for _, words in positive)
        for i, (negative, words) in enumerate(positive + [x for x in items if x[0]]):
            out += [(query_id, c, i, len(positive), n_terms, negative, offset, len(words), w) for offset, w in words if positive]
    return out


def query_pieces(text: str = "query_text") -> F.Column:
    """The pieces of a web-style query, with their tokens."""
    return F.transform(F.regexp_extract_all(F.col(text), F.lit(_PIECE), 0), lambda p: F.struct(p.alias("raw"), tokens(p).alias("words")))


def query_words(text: str = "query_text") -> F.Column:
    return F.array_distinct(content_tokens(text))


# ---------------------------------------------------------------- matching
def _term_rows(postings: DataFrame, terms: set[str], *columns: str) -> DataFrame:
    """The rows of some terms: only their folders and row groups are read."""
    folders = sorted({zlib.crc32(t.encode()) % _FOLDERS for t in terms})
    # one expression text: thousands of separate literal columns take seconds to make; a token holds no backslash
    listed = ", ".join("'" + t.replace("'", "\\'") + "'" for t in sorted(terms))
    asked = F.expr(f"term in ({listed})") if terms else F.lit(False)
    return postings.where(F.col("folder").isin(folders) & asked).select(*(columns or ("term", "df", "n_blocks", "width")))


def match(postings: DataFrame, items: list[tuple], query_id: T.StructField) -> DataFrame:
    """(query_id, chunk_id, keyword_score) for every pair that matches; ``items`` is bounded by the caller.

    Rarest word first: a clause's candidates are the chunks of its rarest
    word; the blocks that may hold them are looked up for its other words.  So
    a common word is never multiplied by the queries that contain it.  Where
    these are too many to be broadcast, chunks are matched part by part.
    """
    spark = postings.sparkSession
    terms = {t: (df, n, width) for t, df, n, width in _term_rows(postings, {i[-1] for i in items}).distinct().collect()}  # one row an asked word
    live, rarest, most = [], [], 0  # most: (word, chunk) pairs to look up, by the document frequencies
    for _, clause in groupby(sorted(items, key=lambda i: (str(i[0]), i[1])), key=lambda i: i[:2]):
        clause = list(clause)
        wanted = [i for i in clause if not i[5]]
        if all(i[-1] in terms for i in wanted):  # else a word that no chunk holds
            df, least = min((terms[i[-1]][0], i[-1]) for i in wanted)
            rarest.append((*clause[0][:2], least))
            live += [(*i, *terms[i[-1]][1:]) for i in clause if i[-1] in terms]
            most += df * len(clause)
    if most > MAX_WANTED:
        return _match_parts(postings, live, rarest, sum(terms[t][0] for t in {i[8] for i in live}), query_id)
    fields = [T.StructField("ask", T.IntegerType()), query_id, *(T.StructField(n, t) for n, t in _ITEM_FIELDS),
              T.StructField("n_blocks", T.IntegerType()), T.StructField("width", T.LongType())]
    # the query side: at most MAX_ITEMS rows, held by the driver anyway
    asked = F.broadcast(spark.createDataFrame([(i, *row) for i, row in enumerate(live)], T.StructType(fields)))
    first = F.broadcast(spark.createDataFrame(rarest, T.StructType([query_id, fields[2], T.StructField("term", T.StringType())])))
    candidates = (_term_rows(postings, {r[-1] for r in rarest}, "term", "postings").join(first, "term")
                  .select("query_id", "clause", F.explode("postings.chunk_id").alias("chunk_id")))
    key = postings.schema["postings"].dataType.elementType["chunk_id"].dataType
    block = _block_of(F.col("chunk_id"), "n_blocks", "width", key).alias("block")
    wanted = F.broadcast(candidates.join(asked, ["query_id", "clause"]).select("ask", "term", block, "chunk_id"))  # most rows
    blocks = _term_rows(postings, {i[-3] for i in live}, "term", "block", "postings")
    held = F.element_at("postings", F.greatest(F.array_position("postings.chunk_id", F.col("chunk_id")), F.lit(1)).cast("int"))
    found = (wanted.join(blocks, ["term", "block"])
             .withColumn("held", held).where(F.col("held.chunk_id") == F.col("chunk_id")).drop("term").join(asked, "ask")
             .select("query_id", "clause", "chunk_id", "ask", F.col("held.positions").alias("positions"))
             .repartition("query_id", "clause", "chunk_id")  # what is known of an asked word is attached where it goes
             .join(asked.select("ask", "item", "n_items", "negative", "offset", "n_words"), "ask"))
    standing = (found.select("*", F.explode("positions").alias("at")).withColumn("pos", F.col("at") - F.col("offset"))
                .groupBy("query_id", "clause", "chunk_id", "item", "n_items", "negative", "n_words", "pos")
                .agg(F.count(F.lit(1)).alias("here")).where(F.col("here") == F.col("n_words")))
    gathered = standing.groupBy("query_id", "clause", "chunk_id", "n_items").agg(
        F.max("negative").alias("excluded"), F.count_distinct(F.when(~F.col("negative"), F.col("item"))).alias("n_found"),
        F.array_sort(F.collect_list(F.when(~F.col("negative"), F.struct("pos", F.col("item").alias("term_idx"))))).alias("occ"))
    full = gathered.where(~F.col("excluded") & (F.col("n_found") == F.col("n_items")))
    scored = full.select("query_id", "chunk_id", cover_density(F.col("occ"), F.col("n_items")).alias("score"))
    return scored.groupBy("query_id", "chunk_id").agg(F.sum("score").alias("keyword_score"))


# ---------------------------------------------------------------- matching by parts of the chunks
def _match_parts(postings: DataFrame, live: list[tuple], rarest: list[tuple], n_postings: int, query_id: T.StructField) -> DataFrame:
    """:func:`match` where candidates are many: an asked word's postings are moved once, packed, to the part of their
    chunk; there all clauses are matched over sorted arrays, so no row is made for a candidate and a word."""
    key = postings.schema["postings"].dataType.elementType["chunk_id"]
    numbered = isinstance(key.dataType, T.LongType)
    parts = max(1, -(-n_postings // PART_POSTINGS))
    number = {t: n for n, t in enumerate(sorted({i[8] for i in live}))}
    rows = _term_rows(postings, set(number), "term", "postings")
    if not numbered:
        rows = rows.withColumn("parts", F.transform("postings.chunk_id", lambda x: F.pmod(F.xxhash64(x), F.lit(parts)).cast("int")))
    packed = [T.StructField("ids", T.BinaryType() if numbered else T.ArrayType(key.dataType)), T.StructField("places", T.BinaryType())]
    held = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("word", T.IntegerType()), *packed])
    dealt = (rows.mapInArrow(lambda batches: _dealt(batches, number, parts), held)
             .repartition(min(parts, _MAX_PARTITIONS), "part").sortWithinPartitions("part", "word"))
    plan = _plan(live, rarest, number)
    names = pa.array([q for q, _ in plan], to_arrow_type(query_id.dataType))
    return dealt.mapInArrow(lambda batches: _matched(batches, plan, names),
                            T.StructType([query_id, key, T.StructField("keyword_score", T.DoubleType())]))


def _plan(live: list[tuple], rarest: list[tuple], number: dict[str, int]) -> list[tuple]:
    """(query id, [(rarest word, n_items, {(item, negative, n_words): [(offset, word)]})]); a query without an id matches nothing."""
    clauses: dict = {}
    for q, clause, item, n_items, _, negative, offset, n_words, term, *_ in live:
        clauses.setdefault((q, clause), {}).setdefault(n_items, {}).setdefault((item, negative, n_words), []).append((offset, number[term]))
    queries: dict = {}
    for q, clause, term in rarest:
        if q is not None:
            queries.setdefault(q, []).extend((number[term], n, items) for n, items in clauses[q, clause].items())
    return list(queries.items())


def _dealt(batches, number: dict[str, int], parts: int):
    """(part, word, ids, places): the postings of asked words by the part of their chunk, ids without null."""
    for batch in _whole(batches, 1024):
        lists = batch.column("postings")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ids, places = (lists.flatten().field(f) for f in ("chunk_id", "positions"))
        code = batch.column("term").dictionary_encode()
        words = np.array([number[t] for t in code.dictionary.to_pylist()], np.int32)
        word = np.repeat(words[code.indices.to_numpy(zero_copy_only=False)], sizes)
        known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
        if "parts" in batch.schema.names:
            part = batch.column("parts").flatten().to_numpy(zero_copy_only=False)
            order = known[np.lexsort((word[known], part[known]))]
        else:
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            part = (numbers // _NEIGHBOURS % parts).astype(np.int32)
            order = known[np.lexsort((numbers[known], word[known], part[known]))]
        if not len(order):
            continue
        part, word = part[order], word[order]
        run = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0))
        n = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        held = _pack(ids.take(pa.array(order)), *_reordered(n, places.flatten().to_numpy().astype(np.int64), order), np.append(run, len(order)))
        yield pa.RecordBatch.from_arrays([pa.array(part[run], pa.int32()), pa.array(word[run], pa.int32()), *held], ["part", "word", "ids", "places"])


def _parts(batches):
    """The rows of each part, which neighbour each other."""
    held = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        ends = [*np.flatnonzero(np.diff(part)) + 1, batch.num_rows]
        for first, end in zip([0, *ends], ends):
            if end > first and held and held[-1].column("part")[0].as_py() != part[first]:
                yield pa.concat_batches(held)
                held = []
            if end > first:
                held.append(batch.slice(first, end - first))
    if held:
        yield pa.concat_batches(held)


def _matched(batches, plan: list[tuple], names: pa.Array):
    """(query_id, chunk_id, keyword_score) of all that match."""
    for rows in _parts(batches):
        ids, sizes, positions, run = _unpack(rows)
        if pa.types.is_int64(ids.type):
            chunks, place = np.unique(ids.to_numpy(), return_inverse=True)
            chunks = pa.array(chunks)
        else:
            coded = ids.dictionary_encode()
            chunks, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.repeat(place, sizes) << 32 | positions + _BASE  # an occurrence: chunk and position
        begin = np.concatenate([[0], np.cumsum(sizes)])[run]
        word = rows.column("word").to_numpy()
        first = np.flatnonzero(np.diff(word, prepend=-1) != 0)
        spans = {w: (begin[a], begin[b]) for w, a, b in zip(word[first].tolist(), first, np.append(first[1:], len(word)))}
        known: dict[int, tuple[np.ndarray, bool]] = {}

        def occurrences(w: int) -> tuple[np.ndarray, bool]:
            """Ascending, and whether one is there twice: where rows of one chunk share a posting."""
            if w not in known:
                a, b = spans.get(w, (0, 0))
                own = np.sort(at[a:b], kind="stable")
                known[w] = own, bool((own[1:] == own[:-1]).any())
            return known[w]

        out, n = [], 0
        for q, (_, clauses) in enumerate(plan):
            found = [x for c in clauses if c[0] in spans and len((x := _clause(*c, occurrences))[0])]
            if not found:
                continue
            where, score = (np.concatenate(x) for x in zip(*found))
            if len(found) > 1:  # clauses add up
                where, same = np.unique(where, return_inverse=True)
                score = np.bincount(same, score)
            out.append((np.full(len(where), q), where, score))
            n += len(where)
            if n >= 1 << 20:
                yield _named(out, names, chunks)
                out, n = [], 0
        if out:
            yield _named(out, names, chunks)


def _named(found: list[tuple], names: pa.Array, chunks: pa.Array) -> pa.RecordBatch:
    query, where, score = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([names.take(pa.array(query)), chunks.take(pa.array(where)), pa.array(score, pa.float64())],
                                      ["query_id", "chunk_id", "keyword_score"])


def _among(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which of ``few`` are in ``many``; both ascend."""
    if not len(many):
        return np.zeros(len(few), bool)
    return many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few


def _chunks_of(at: np.ndarray) -> np.ndarray:
    chunk = at >> 32
    return chunk[np.diff(chunk, prepend=-1) != 0]


def _standing(words: list[tuple[int, int]], n_words: int, occurrences) -> np.ndarray:
    """Where an item stands: so many occurrences of its words, each at its distance."""
    found = [(*occurrences(w), offset) for offset, w in words]
    each = sorted((at - offset for at, _, offset in found), key=len)
    if len(each) > n_words or any(repeated for _, repeated, _ in found):  # also a query or a chunk that is there twice
        at, n = np.unique(np.concatenate(each), return_counts=True)
        return at[n == n_words]
    at = each[0] if len(each) == n_words else each[0][:0]
    for other in each[1:]:
        at = at[_among(at, other)]
    return at


def _clause(rare: int, n_items: int, items: dict, occurrences) -> tuple[np.ndarray, np.ndarray]:
    """The chunks that match a clause, and their cover densities."""
    chunks = _chunks_of(occurrences(rare)[0])
    wanted: dict[int, list[np.ndarray]] = {}
    for (item, negative, n_words), words in sorted(items.items(), key=lambda x: (x[0][1], x[0][0])):
        if not len(chunks):
            break
        at = _standing(words, n_words, occurrences)
        if negative:
            chunks = chunks[~_among(chunks, _chunks_of(at))]
        else:
            wanted.setdefault(item, []).append(at)
    if len(wanted) == n_items:
        for each in wanted.values():
            chunks = chunks[_among(chunks, _chunks_of(each[0] if len(each) == 1 else np.sort(np.concatenate(each))))]
    if len(wanted) != n_items or not len(chunks):
        return chunks[:0], np.zeros(0)
    at, item = [], []
    for i, each in sorted(wanted.items()):
        for x in each:
            first = np.searchsorted(x, chunks << 32)
            at.append(x[_slices(first, np.searchsorted(x, (chunks + 1) << 32) - first)])
            item.append(np.full(len(at[-1]), i))
    at, item = np.concatenate(at), np.concatenate(item)
    order = np.argsort(at, kind="stable")  # by chunk, position, item
    return chunks, _densities(at[order], item[order], np.unique(item))


def _densities(at: np.ndarray, item: np.ndarray, items: np.ndarray) -> np.ndarray:
    """:func:`cover_density` of each chunk, from its occurrences in order; every item stands in every chunk."""
    n = np.arange(len(at))
    chunk = at >> 32
    begins = np.diff(chunk, prepend=-1) != 0
    own = np.cumsum(begins) - 1
    first = n[begins][own]
    start = np.full(len(at), len(at))
    for i in items:
        np.minimum(start, np.maximum.accumulate(np.where(item == i, n, -1)), out=start)
    emit = np.flatnonzero((start >= first) & (np.diff(start, prepend=-1) > 0))  # one cover for each start
    start = start[emit]
    noise = at[emit] - at[start] - (emit - start)
    with np.errstate(divide="raise"):  # as cover_density does: a phrase and its own first word at one place
        return np.bincount(own[emit], COVER_WEIGHT / (1.0 + noise), own[-1] + 1)


def keyword_pairs(index: DataFrame, queries: DataFrame, postings: DataFrame | None = None, syntax: str = "plain") -> DataFrame:
    """:func:`match` for a table of queries; without stored ``postings`` the index is built first."""
    ask = query_words() if syntax == "plain" else query_pieces()
    rows = queries.select("query_id", ask.alias("asked")).limit(MAX_ITEMS + 1).collect()
    make = plain_items if syntax == "plain" else web_items
    items = [i for r in rows for i in make(r["query_id"], r["asked"] or [])]
    if len(rows) > MAX_ITEMS or len(items) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} query words at once: split the query table")
    pairs = match(build_postings(index) if postings is None else postings, items, queries.schema["query_id"])
    if posting_key(index) == "chunk_id":
        return pairs
    # rows of one chunk have one number: names are made distinct, so the named pairs, which are more, need not be
    names = index.select("chunk_no", "chunk_id").repartition("chunk_no").distinct()
    return pairs.withColumnRenamed("chunk_id", "chunk_no").join(names, "chunk_no").select("query_id", "chunk_id", "keyword_score")
