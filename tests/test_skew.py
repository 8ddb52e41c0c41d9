"""Skew-safe scans: a source holding most rows is split over tasks and still scanned in order."""

import random
from datetime import datetime, timedelta

from parchment.operators import ingest, scan
from parchment.sources.fixtures import registry_from_ids


def _fetches(n=3000, hot_share=0.7, seed=5):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        src = "src1" if rnd.random() < hot_share else f"src{rnd.randint(2, 9)}"
        h = None if rnd.random() < 0.2 else str(rnd.randint(0, 3))
        rows.append((i, src, t0 + timedelta(seconds=rnd.randint(0, 10 ** 6)), h))
    return rows


def _loop(rows):
    last, out = {}, {}
    for eid, src, ts, h in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        prev = last.get(src)
        out[eid] = "failed" if h is None else ("unchanged" if prev is not None and h == prev else "success")
        if h is not None:
            last[src] = h
    return out


def test_hot_source_change_detection_matches_sequential_loop(spark):
    rows = _fetches()
    df = spark.createDataFrame(rows, "event_id long, source_id string, fetched_at timestamp, content_hash string")
    reg = registry_from_ids(spark.createDataFrame([(f"src{i}",) for i in range(1, 10)], "source_id string"))
    got = {r["event_id"]: r["status"] for r in ingest.classify_fetches(df, reg).collect()}
    assert got == _loop(rows)


def test_hot_key_row_numbers_and_running_sums(spark):
    rows = [(("hot" if i % 10 else f"k{i}"), i, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    rn = {(r["k"], r["t"]): r["rn"] for r in scan.row_number_by(df, ["k"], ["t"], "rn").collect()}
    hot = sorted(t for k, t in rn if k == "hot")
    assert [rn[("hot", t)] for t in hot] == list(range(1, len(hot) + 1))
    rs = scan.running_sum_by(df, ["k"], ["t"], ["v"], ["cv"]).where("k = 'hot'").orderBy("t").collect()
    assert [r["cv"] for r in rs] == list(range(1, len(hot) + 1))
