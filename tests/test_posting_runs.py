"""Postings are made as runs, hold numbers where the index has them, and one posting a chunk."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from parchment.functions import embedding
from parchment.operators import keyword
from parchment.plans import corpus

BASE = [(f"{i:064d}", "common " * (i % 3 + 1) + f"word{i % 40} tail {i}", i) for i in range(500)]


def test_postings_hold_numbers(spark):
    index = spark.createDataFrame(BASE, "chunk_id string, chunk_text string, chunk_no long").repartition(3)
    asked = spark.createDataFrame([(1, "common word7"), (2, "tail 11")], "query_id long, query_text string")
    stored = keyword.build_postings(index)
    assert stored.schema["postings"].dataType.elementType["chunk_id"].dataType.typeName() == "long"
    named = index.drop("chunk_no")
    want = {tuple(r) for r in keyword.keyword_pairs(named, asked, keyword.build_postings(named)).collect()}
    assert {tuple(r) for r in keyword.keyword_pairs(index, asked, stored).collect()} == want and len(want) == 14
    blocks = stored.where("term = 'common'").collect()
    assert len(blocks) == 4 and sum(len(b.postings) for b in blocks) == 500 == blocks[0].df


def test_rows_of_one_chunk_share_a_posting(spark):
    index = spark.createDataFrame([("a", "x y"), ("a", "y y x"), ("b", "x"), ("c", None)], "chunk_id string, chunk_text string").repartition(3)
    got = {(r.term, p.chunk_id): p.positions for r in keyword.build_postings(index).collect() for p in r.postings}
    assert got == {("x", "a"): [0, 2], ("y", "a"): [0, 1, 1], ("x", "b"): [0]}
    assert {r.term: r.df for r in keyword.build_postings(index).collect()} == {"x": 3, "y": 2}


def test_vectors_do_not_depend_on_the_batch(monkeypatch):
    texts = pd.Series([f"one word{i % 5} and tail {i}" for i in range(50)] + [None, ""])
    want, sizes, whole = embedding.embed_batch(texts), [], embedding.embed_batch
    monkeypatch.setattr(embedding, "_TEXTS", 7)
    monkeypatch.setattr(embedding, "embed_batch", lambda t, *a: sizes.append(len(t)) or whole(t, *a))
    got = embedding._make_udf(embedding.EMBEDDING_MODEL, embedding.EMBEDDING_DIMENSION).func(texts)
    assert (np.stack(list(got)) == want.astype(np.float32)).all() and max(sizes) == 7


def test_packed_postings_come_back_whole():
    far = [5, 6, 300, 7 << 33, (7 << 33) + 1, -4, 9]  # ascending or not, negative, of another partition
    positions = [[0], [3, 9, 400], [70000], [1, 2], [0], [8], [2, 2_000_000_000]]
    sizes, flat, run = np.array([len(p) for p in positions]), np.concatenate(positions), np.array([0, 3, 4, 7])
    for ids in (pa.array(far, pa.int64()), pa.array([str(x) for x in far])):
        rows = pa.RecordBatch.from_arrays(keyword._pack(ids, sizes, flat, run), ["ids", "places"])
        assert [x.tolist() for x in keyword._unpack(rows)] == [ids.tolist(), sizes.tolist(), flat.tolist(), run.tolist()]
        ids2, sizes2, flat2, run2 = keyword._unpack(rows.slice(1, 2))
        assert (ids2.tolist(), sizes2.tolist(), run2.tolist()) == (ids.tolist()[3:], sizes.tolist()[3:], [0, 1, 4]) and flat2.tolist() == flat[5:].tolist()


def test_runs_move_few_bytes():
    """A posting of a numbered chunk takes a few bytes on its way, and a run's postings are cut into few pieces."""
    words = [[f"w{i % 7}", "the", f"w{i % 7}"] for i in range(4096)]
    ids = (3 << 33) + np.arange(4096)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(words)], ["chunk_id", "words"])
    run, = keyword._runs([batch])
    assert run.num_rows == 8 and run.column("n").to_pylist()[run.column("term").to_pylist().index("the")] == 4096
    assert run.column("ids").nbytes + run.column("places").nbytes < 2 * 4096 * 4
    placed = run.append_column("df", run.column("n")).append_column("n_blocks", pa.array([32] * 8, pa.int32()))
    placed = placed.append_column("width", pa.array([128] * 8, pa.int64()))
    cut = pa.Table.from_batches(keyword._cut([placed]))
    assert cut.num_rows == 8 * 32 and sorted(set(cut.column("block").to_pylist())) == list(range(32))
    got, _, _, _ = keyword._unpack(cut.combine_chunks().to_batches()[0])
    assert sorted(got.to_pylist()) == sorted(ids.tolist() * 2)


def test_blocks_across_batches():
    """A block whose rows lie in several batches stays one block."""
    ids, sizes, run = pa.array(range(6), pa.int64()), np.ones(6, int), np.arange(7)
    held = keyword._pack(ids, sizes, np.arange(6), run)
    n = pa.array([1] * 6, pa.int32())
    rows = pa.RecordBatch.from_arrays([pa.array(["a", "b", "b", "b", "b", "c"]), pa.array([None] * 6, pa.int64()), n, n.cast("int64"),
                                       pa.array([0, 0, 0, 0, 1, 0], pa.int32()), *held, n], ["term", "df", "n_blocks", "width", "block", "ids", "places", "folder"])
    got = pa.Table.from_batches(keyword._gathered([rows.slice(i, 1) for i in range(6)])).to_pylist()
    assert [(g["term"], g["block"], g["df"], [(x["chunk_id"], x["positions"]) for x in g["postings"]]) for g in got] == [
        ("a", 0, 1, [(0, [0])]), ("b", 0, 3, [(1, [1]), (2, [2]), (3, [3])]), ("b", 1, 1, [(4, [4])]), ("c", 0, 1, [(5, [5])])]


def test_neighbours_share_a_block(spark):
    """The block that a query looks in is the one that the index put a number in; a stretch of numbers has few blocks."""
    index = spark.range(4000).selectExpr("concat('c', id) chunk_id", "'common ' || id chunk_text", "id chunk_no").repartition(3)
    stored = keyword.build_postings(index).where("term = 'common'")
    blocks = stored.select("n_blocks", "width", "block", F.explode("postings.chunk_id").alias("no"))
    asked = keyword._block_of(F.col("no"), "n_blocks", "width", blocks.schema["no"].dataType)
    assert blocks.where(asked == F.col("block")).count() == 4000 and stored.count() == 32
    assert blocks.where("no < 45").select("block").distinct().count() == 3  # 15 neighbours at a time


def test_chunk_numbers_have_no_gaps(spark):
    rows = spark.range(0, 1000, 1, 7).withColumn("chunk_no", F.monotonically_increasing_id()).where("id < 400 or id > 700")
    assert sorted(r.chunk_no for r in corpus._counted(rows).collect())[-1] < 1000
    full = corpus._counted(spark.range(0, 1000, 1, 7).withColumn("chunk_no", F.monotonically_increasing_id()))
    assert sorted(r.chunk_no for r in full.collect()) == list(range(1000))
    assert corpus._counted(full.limit(0)).count() == 0
