"""HMM scoring, hard-negative mining and the prefix trie against brute force, on small tables with awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchment.llm import hard_negatives, hidden_markov, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    k, v = 3, 5
    chain = hidden_markov.Chain(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k))
    emit = rng.dirichlet(np.ones(v), k).T
    texts = [rng.integers(0, v, n) for n in (1, 4, 2, 5, 1)]
    steps = hidden_markov.Steps(np.concatenate(texts).astype(np.int32), np.array([len(t) for t in texts]))
    first, moves, by_key = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
    logs = []
    for text in texts:
        total, f, m, b = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
        for path in np.ndindex(*[k] * len(text)):
            p = chain.start[path[0]] * emit[text[0], path[0]]
            for i in range(1, len(text)):
                p *= chain.move[path[i - 1], path[i]] * emit[text[i], path[i]]
            total += p
            f[path[0]] += p
            for i, s in enumerate(path):
                b[text[i], s] += p
                if i:
                    m[path[i - 1], s] += p
        logs.append(math.log10(total))
        first, moves, by_key = first + f / total, moves + m / total, by_key + b / total
    got = chain.expect(emit, steps, np.arange(v), v)
    np.testing.assert_allclose(chain.log10(emit, steps), logs)
    for a, b in zip(got, (first, moves, by_key)):
        np.testing.assert_allclose(a, b)


def test_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    chain, emit = hidden_markov.Chain(np.array([0.4, 0.6]), np.array([[0.9, 0.1], [0.3, 0.7]])), rng.random((7, 2))
    sizes = np.array([500, 3, 120, 500, 1])
    steps = hidden_markov.Steps(rng.integers(0, 7, sizes.sum()).astype(np.int32), sizes)
    whole = chain.log10(emit, steps), chain.expect(emit, steps, np.arange(7), 7)
    monkeypatch.setattr(hidden_markov, "HELD_TOKENS", 64)
    assert len(steps.pieces()) > 10
    np.testing.assert_allclose(chain.log10(emit, steps), whole[0])
    for a, b in zip(chain.expect(emit, steps, np.arange(7), 7), whole[1]):
        np.testing.assert_allclose(a, b)


def _texts(rng):
    sides = [[f"é{i}" for i in range(30)], [f"Wort{i}" for i in range(30)]]
    texts = [" ".join(rng.choice(sides[i % 2], rng.integers(1, 60))) for i in range(120)]
    return texts + [None, "", " \t\n", "NEVER\x0bseen\x1cword", texts[0], " ".join(rng.choice(sides[0], 5000))]


def test_hmm_score(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(_texts(np.random.default_rng(3)))]
    rows += [rows[3], rows[3], (None, rows[4][1], "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, c int").repartition(3)
    words = [[w.lower() if w.isascii() else "".join(c.lower() if c < "\x80" else c for c in w) for w in WORD.findall(t or "")] + [""]
             for _, t, *_ in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, *_ in rows]
    learn = [d is not None and not h for (d, *_), h in zip(rows, held)]
    count = collections.Counter(w for ws, ok in zip(words, learn) if ok for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if d is None else d, h, len(ws), sum(count[w] > 0 for w in ws), n,
                   round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
                  for (d, *_), h, ws in zip(rows, held, words))
    for block_bytes in (1 << 25, 2000):
        got = hidden_markov.score(docs, states=2, rounds=6, block_bytes=block_bytes).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                      for r in got) == want
    # two vocabularies that never mix: a model with memory beats the unigram by about log10(2) a word
    assert sum(r.score - r.base_score for r in got if r.held_out) > 0.2 * sum(r.n_tokens for r in got if r.held_out)
    again = {r.doc_id: r.score for r in hidden_markov.score(docs, states=2, rounds=6).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-3 * r.n_tokens for r in got)  # training sums in single precision
    assert hidden_markov.score(docs.limit(0)).count() == 0
    alone = hidden_markov.score(docs.where("doc_id is null")).first()
    assert (alone.base_score, round(alone.score, 9), alone.n_known, alone.train_tokens) == (0.0, 0.0, 0, 0)


def test_word_probabilities_sum_to_one(spark):
    """With one state the model is the unigram."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(np.random.default_rng(4)))], "doc_id long, text string")
    for r in hidden_markov.score(docs, states=1, rounds=1).collect():
        assert abs(r.score - r.base_score) < 1e-5 * r.n_tokens


def _mined(rows, is_anchor, k=5):
    good = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in e]) for i, lab, e, *_ in rows
            if i is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, lab, q in (r for r in good if is_anchor(r[0])):
        scored = sorted((-sum(x * y for x, y in zip(q, e)), i, o) for i, o, e in good if i != a)
        for p, pid, _ in [s for s in scored if s[2] == lab][:k]:
            fits = [(s, i) for s, i, o in scored if o != lab and 80 * -p <= 100 * -s <= 100 * -p][:k]
            out += [(a, pid, rank + 1, i, -p, -s) for rank, (s, i) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(3, 16))
    rows = [(i, int(rng.integers(0, 3)), (rng.normal(size=16) * 0.6 + centre[i % 3]).tolist(), "x", i) for i in range(300)]
    rows += [rows[7], rows[0], (301, None, [1.0], "x", 0), (302, 1, None, "x", 0), (303, 1, [1.0, None], "x", 0),
             (304, 2, [float("nan")] * 16, "x", 0), (305, 2, [float("inf")], "x", 0), (None, 1, [1.0], "x", 0), (306, 1, [], "x", 0),
             (307, 0, [0.0] * 16, "x", 0), (308, 0, [2.0, 1.0], "x", 0)]
    rows += [(400 + i, i % 2, rows[20][2], "x", 0) for i in range(60)]  # equal vectors: ties
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, ask string, score int").repartition(4)
    monkeypatch.setattr(hard_negatives, "ROW_BOX", 32)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BOX", 7)
    want = _mined(rows, lambda i: i % 20 == 0)
    assert len(want) > 50
    for rounds in ((0.7, 0.45, 0.25), (0.3,), ()):
        monkeypatch.setattr(hard_negatives, "POSITIVE_ROUNDS", rounds)
        got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0).collect()
        assert sorted(map(tuple, got)) == want
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    huge = [(i, i % 2, [float(3e30 if i % 3 else 2e30), 1.0]) for i in range(12)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(huge, "vec_id long, label int, embedding array<float>"), F.col("vec_id") == 0)
    assert {r.positive_score for r in got.collect()} == {(1 << 63) - 1}


def test_hmm_dictionaries_are_dealt_in_large_batches(spark, monkeypatch):
    asked, stage = {}, hidden_markov.stage
    monkeypatch.setattr(hidden_markov, "stage", lambda df, name, *rows: asked.setdefault(name, rows) and None or stage(df, name, *rows))
    docs = spark.createDataFrame([(i, f"one word{i} two") for i in range(20)], "doc_id long, text string")
    assert hidden_markov.score(docs, rounds=1).count() == 20
    assert asked["hmm-scores"][0] >= 1024  # eight rows at a time took most of the scoring's time


def test_pruned_scores_lose_no_pair():
    rng = np.random.default_rng(6)
    for _ in range(60):
        q, x = (np.floor(40 * rng.normal(size=(n, 24)) * rng.random((n, 1))) for n in (6, 200))
        full = q @ x.T
        low = rng.uniform(0.3, 1.1, 6) * full.max(1)
        got = hard_negatives.reach(q, low, x)
        assert (got[full >= low[:, None]] == full[full >= low[:, None]]).all()
        assert ((got == full) | np.isneginf(got)).all()


def _tree(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    nodes = collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes[tuple(rebuilt[c][:d])].append(c)
    kids = collections.Counter(n[:-1] for n in nodes if n)
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[:len(n)] == n]
        ends = ",".join(str(c) for c in members if len(rebuilt[c]) == len(n))
        out.append((members[0], len(n), nodes[n[:-1]][0] if n else None, len(members), kids[n], sum(not kids[m] for m in below),
                    sum((len(nodes[m]) - 1) * len(WORD.findall(m[-1][1])) for m in below if m), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0], r[2] or 0, r[7]))


@pytest.fixture(scope="module")
def talks():
    rng = np.random.default_rng(7)
    rows = []
    for c in [*range(0, 70), 95, 121, -7, -20]:
        for t in range(rng.integers(1, 7)):
            rows.append((c, t if t else None, ["user", None, "assistant"][t % 3], f"turn {rng.integers(0, 3)}\tof é {t}", "x", 0))
    rows += [(200 + c, t, "user", f"same words {t}", "x", 0) for c in range(80) for t in range(5)]  # many equal conversations
    rows += [(200 + c, 5, "user", "end", "x", 0) for c in range(0, 80, 3)]  # of which some go on
    rows += [(301, 0, "user", "only", "x", 0), (302, 0, None, None, "x", 0), (None, 0, "user", "nobody", "x", 0), (303, 1, "", "", "x", 0)]
    rows += [(305, t, "user", "again and again", "x", 0) for t in range(300)]
    return rows


@pytest.mark.parametrize(("partitions", "chains"), [(1, 4096), (7, 4096), (40, 4)])
def test_prefix_trie(spark, talks, partitions, chains):
    frame = spark.createDataFrame(talks, "conv_id long, turn int, role string, text string, path string, node int").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in prefix_trie.prefix_trie(frame, chains=chains).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=lambda r: (r[1], r[0], r[2] or 0, r[7])) == _tree(talks)


def test_prefix_trie_without_rows(spark, talks):
    frame = spark.createDataFrame(talks, "conv_id long, turn int, role string, text string, path string, node int")
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0
    assert prefix_trie.prefix_trie(frame.where("conv_id is null")).count() == 0


def test_radix_tree_layouts():
    rng = np.random.default_rng(8)
    root, want = prefix_trie.Node(b""), {}
    for i, n in enumerate(rng.integers(1, 5, 4000)):
        key = bytes(rng.integers(0, 256, n).astype(np.uint8))
        prefix_trie.reach(root, key).held = want[key] = i
    assert root.keys is None  # grown to 256 slots

    def walk(node, path):
        path += node.prefix
        if node.held is not None:
            yield path, node.held
        for _, child in node.children():
            yield from walk(child, path)

    assert list(walk(root, b"")) == sorted(want.items())


def test_quality_with_few_labels(spark):
    """Five labelled rows a class give graded scores that tell the classes apart."""
    from parchment.llm import quality

    rng = np.random.default_rng(9)
    prose = "The river runs slowly past old towns and their fields in summer".split()
    junk = ["".join(rng.choice(list("#$%&@01"), 6)) for _ in range(30)]
    rows = []
    for i in range(80):  # even ids: half junk or more, odd ids: less
        share = rng.uniform(0.5, 0.8) if i % 2 == 0 else rng.uniform(0.1, 0.4)
        rows.append((i, " ".join(rng.choice(junk if rng.random() < share else prose) for _ in range(rng.integers(40, 120)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 5]
    few = [(d, d % 2) for k in (0, 1) for d in [d for d in known if d % 2 == k][:5]]
    got = quality.score(docs, quality.fit(docs, spark.createDataFrame(few, "doc_id long, quality int"))).collect()
    assert len({round(r.score, 6) for r in got}) > 20
    assert sum((r.score >= 0.5) == r.doc_id % 2 for r in got) >= 70


def test_quality_against_densities():
    """The score is the tempered difference of two normal log densities with shrunk covariances."""
    from parchment.llm import quality

    rng, d = np.random.default_rng(10), quality.N_STATISTICS
    x = [rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + k for k, n in enumerate((40, 9))]
    model = quality.discriminant({k: (float(len(v)), v.sum(0), v.T @ v) for k, v in enumerate(x)})
    common = sum((v - v.mean(0)).T @ (v - v.mean(0)) for v in x) / 49
    logs, probe = [], rng.normal(size=(6, d))
    for v in x:
        cov = ((v - v.mean(0)).T @ (v - v.mean(0)) + quality.PRIOR_ROWS * common) / (len(v) + quality.PRIOR_ROWS)
        cov = 0.8 * cov + 0.1 * np.diag(np.diag(cov)) + 0.1 * np.trace(cov) / d * np.eye(d)
        off = probe - v.mean(0)
        logs.append(math.log(len(v) / 49) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (off @ np.linalg.inv(cov) * off).sum(1))
    want = 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / math.sqrt(d), -50, 50)))
    np.testing.assert_allclose(model.score(probe), want, rtol=1e-6, atol=1e-12)


def test_repeated_words_are_compared_whole():
    from parchment.llm import quality

    raw = np.frombuffer(b"longwordA longwordB longwordB ab ab abcdefghijklmnopqX abcdefghijklmnopqX abcdefghijklmnopqY", np.uint8)
    solid = raw != 32
    first = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    last = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]]))
    assert quality._repeated(raw, first, last, np.zeros(len(raw), int)).tolist() == [first[2], first[4], first[6]]


def test_language_against_ridge(spark):
    """The folded coefficients give the outputs of one-versus-rest kernel ridge in the landmarks' span; ``fit_rows`` is obeyed."""
    import pyarrow as pa

    from parchment.llm import language

    rng = np.random.default_rng(11)
    texts = [" ".join(rng.choice(["haus", "baum", "wald"] if i % 2 else ["house", "tree", "wood"], 6)) + f" {i}" for i in range(60)]
    labels = ["de" if i % 2 else "en" for i in range(60)]
    found = language.presence(pa.array(texts))
    model = language.solve(found, labels, landmarks=20, ridge=1e-2)
    sets = [set(x.tolist()) for x in found]
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    marks = [i for pair in zip([i for i in range(60) if i % 2], [i for i in range(60) if not i % 2]) for i in pair][:20]
    near, inner = kernel[:, marks], kernel[np.ix_(marks, marks)]
    y = np.array([[1.0 if lab == k else -1.0 for k in ("de", "en")] for lab in labels])
    alpha = np.linalg.solve(near.T @ near + 60 * 1e-2 * inner + 60 * 1e-8 * np.eye(20), near.T @ y)
    np.testing.assert_allclose(model.score(found), near @ alpha, atol=1e-3)
    seen = []
    solve, language.solve = language.solve, lambda rows, labels: seen.append(collections.Counter(labels)) or solve(rows, labels)
    try:
        rows = [(i, f"{'haus baum' if i % 2 else 'house tree'} {i}", "de" if i % 2 else "en") for i in range(4000)]
        language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=2600)
    finally:
        language.solve = solve
    assert seen == [{"de": 1300, "en": 1300}]
