"""op7's pairs of blocks: neither side broadcast, and the k best kept over all blocks a task meets."""

import numpy as np
import pytest

from parchment.llm import topk


def _best(weights, queries, k):
    want = set()
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(weights[q], weights[c])), c) for c in weights if c != q)
        want |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(scored[:k])}
    return want


def test_neither_side_is_broadcast_or_dealt_out(spark, monkeypatch):
    made, whole = {}, topk.stage
    monkeypatch.setattr(topk, "stage", lambda df, name, *a: made.setdefault(name, df) is df and whole(df, name, *a))
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(400)]  # many equal scores
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(frame, frame["vec_id"] % 20 == 0).collect()
    assert {tuple(r) for r in got} == _best({i: [int(256 * x) for x in v] for i, v in vectors}, range(0, 400, 20), 5)
    plan = made["topk-best"]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("largest", [3, 1 << 20, 1 << 60])  # 32 bits, 64 bits, beyond
def test_best_are_merged_over_blocks(largest):
    rng = np.random.default_rng(4)
    whole = rng.integers(-largest, largest + 1, (3, 3000)).astype(float)
    whole[:, 1500:2600] = whole[:, :1]  # one vector 1,101 times
    ids = np.sort(rng.permutation(9000)[:3000])
    asked = np.array([0, 7, 1600, 2999])
    best = None
    for first in range(0, 3000, 1300):
        best = topk.select(ids[asked], whole[:, asked], ids[first:first + 1300], whole[:, first:first + 1300], 5, best)
    exact = {int(i): [int(x) for x in whole[:, n]] for n, i in enumerate(ids)}
    want = {(q, c, min(topk._MOST, max(topk._LEAST, s))) for q, _, c, s in _best(exact, [int(i) for i in ids[asked]], 5)}
    got = {(int(ids[asked][a]), int(f), int(s)) for a, f, s in zip(*best)}
    clamped = {q for q, _, s in want if s == topk._MOST}
    assert len(best[0]) == 20 and {x for x in got if x[0] not in clamped} == {x for x in want if x[0] not in clamped}
    assert all(s == topk._MOST for q, _, s in got if q in clamped)
