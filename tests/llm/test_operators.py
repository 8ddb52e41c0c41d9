"""The corpus operators against brute force, on small tables with awkward rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from parchment.llm import exact_dedup, exchange, language, licenses, mixing, packing, quality, shingle_join, suffix_dedup, topk, warc
from parchment.llm.queries import word_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, block string, kept string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(300)]
    long = " ".join(rng.choices(vocabulary, k=6000))
    base = rng.choices(vocabulary, k=120)
    rows = [None, "", " \t\n ", "one", "a b", "Same text here now", "same  text\there now", "SAME TEXT HERE NOW", long, long,
            "Released under the MIT License. " + long[:500], "<|ENDOFTEXT|> <|endoftext|> İstanbul don't"]
    for _ in range(40):  # a family of near copies, some linked, some not
        w = list(base)
        for i in rng.sample(range(120), rng.choice([1, 2, 3, 5])):
            w[i] = rng.choice(vocabulary)
        rows.append(" ".join(w))
    rows += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(40)]
    return rows


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    out = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None, "Z"][i % 4], "x", "y", i) for i, t in enumerate(texts)]
    out += [out[5], out[5], out[0]]  # repeated rows
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 9, 5000):
        v = np.unique(rng.integers(0, 1 << 50, n, dtype=np.uint64)) + np.uint64(3 << 50)
        assert (exchange.ungolomb(exchange.golomb(v, 3 << 50, 1 << 50), 3 << 50) == v).all()


def test_suffix_dedup(docs, rows, nothing):
    width, first, want = 50, {}, {}
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    for d in sorted(texts):
        for i in range(len(texts[d]) - width + 1):
            first.setdefault(texts[d][i:i + width], d)
    for d, b in texts.items():
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < d:
                gone[i:i + width] = b"\1" * width
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        want[d] = (len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept)
    got = suffix_dedup.dedup_substrings(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) == want[r.doc_id]
    assert suffix_dedup.dedup_substrings(nothing).count() == 0


def test_packing(docs, rows, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_tokenizer())
    got = packing.pack(docs, word_tokenizer()).collect()
    ids = {r[0]: np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4") for r in rows}
    count = collections.Counter(r[0] for r in rows)
    assert sum(r.length for r in got) == sum(len(ids[d]) * c for d, c in count.items())
    used = collections.defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == 2048 * r.piece and len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        used[r.sequence_id].append((r.offset, r.length))
    for slots in used.values():
        slots.sort()
        assert [o for o, _ in slots] == [sum(n for _, n in slots[:i]) for i in range(len(slots))]
        assert sum(n for _, n in slots) <= 2048
    assert len(used) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack(nothing, word_tokenizer()).count() == 0


def test_license_scan(spark, nothing):
    mit, apache = licenses.TEMPLATES["MIT-grant"], licenses.TEMPLATES["Apache-2.0-short"]
    rows = [(1, "x " * 50 + mit + " tail"), (2, mit.replace("free of charge", "free of any charge").upper()), (3, None), (4, ""),
            (5, "permission is hereby refused to all"), (None, apache + "\n" + apache), (7, mit[:60])]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = collections.Counter((r.doc_id, r.license) for r in got)
    assert found == {(1, "MIT-grant"): 1, (2, "MIT-grant"): 1, (None, "Apache-2.0-short"): 2}
    whole = next(r for r in got if r.doc_id == 1)
    assert whole.coverage == 1 and rows[0][1].encode()[whole.start:whole.stop].decode() == mit
    assert next(r for r in got if r.doc_id == 2).coverage > 0.9
    assert licenses.scan(nothing).count() == 0


def test_license_scan_finds_every_adjacent_copy(spark):
    rows = [(i, name, n, gap) for i, (name, n, gap) in enumerate(
        (name, n, gap) for name in licenses.TEMPLATES for n in (2, 3, 7) for gap in ("", "\n", " see also "))]
    texts = [(i, gap.join([licenses.TEMPLATES[name]] * n)) for i, name, n, gap in rows]
    texts += [(1000, "Licensed under CC BY-NC 4.0.\n" * 9000)]
    got = collections.Counter((r.doc_id, r.license, r.coverage) for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert got == {(i, name, 1.0): n for i, name, n, _ in rows} | {(1000, "CC-BY-NC-4.0-short", 1.0): 9000}


def _matched(template, text):
    """The most letters of ``template`` that a local alignment (1 a match, -1 a mismatch or gap) of positive score matches."""
    most, above = 0, [(0, 0)] * (len(text) + 1)
    for a in template:
        row = [(0, 0)]
        for j, b in enumerate(text):
            (s, m), (u, v), (x, y) = above[j], above[j + 1], row[j]
            best = max((s + 1, m + 1) if a == b else (s - 1, m), (u - 1, v), (x - 1, y))
            row.append(best if best[0] > 0 else (0, 0))
            most = max(most, row[-1][1])
        above = row
    return most


def test_license_scan_finds_every_edited_notice(spark):
    rng = random.Random(8)
    plain = {n: re.sub("[^a-z0-9]", "", t.lower()) for n, t in licenses.TEMPLATES.items()}
    words = "the quick license under a version of public work may be released and licensed by anyone who reads it".split()
    texts = [(0, "CC", "Licensed under the CC BY-NC 4.0"), (0, "MIT", "Released under MIT License"), (0, "CC", "Licensed under CD BY-NC 4.0.")] * 20
    for name, letters in plain.items():
        for _ in range(20 if len(letters) < 80 else 2):
            x = list(letters)
            for place in rng.sample(range(len(x)), rng.randint(1, len(x) - -(-4 * len(x) // 5))):
                x[place] = rng.choice(["", "q", x[place] + "q"])
            texts.append((0, name, "".join(x)))
    texts = [(i, name, " ".join([*rng.choices(words, k=9), t, *rng.choices(words, k=9)])) for i, (_, name, t) in enumerate(texts)]
    want = set()
    for i, _, t in texts:
        letters = re.sub("[^a-z0-9]", "", t.lower())
        if any(_matched(p, letters) >= 0.8 * len(p) for p in plain.values()):
            want.add(i)
    got = licenses.scan(spark.createDataFrame([(i, t) for i, _, t in texts], "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == want and len(want) > 0.8 * len(texts)
    assert all(round(r.coverage * len(plain[r.license])) >= 0.8 * len(plain[r.license]) for r in got)


def test_license_scan_keeps_the_longer_notice(spark):
    edited = licenses.TEMPLATES["Apache-2.0-notice"].replace("compliance", "complience")
    got = licenses.scan(spark.createDataFrame([(1, "x " * 30 + edited + " ..."), (2, licenses.TEMPLATES["Apache-2.0-short"])], "doc_id long, text string"))
    (long,), (short,) = (got.where(f"doc_id = {i}").collect() for i in (1, 2))
    assert long.license == "Apache-2.0-notice" and 0.98 < long.coverage < 1 and (long.start, long.stop) == (60, 60 + len(edited))
    assert (short.license, short.coverage) == ("Apache-2.0-short", 1.0)


@pytest.mark.parametrize("rule", [shingle_join.QUERY_RULE, shingle_join.STAGE_RULE])
def test_shingle_join(docs, rows, nothing, rule):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, text, *_ in rows:
        w = WORD.findall((text or "").translate(lower))
        sets[d] = {tuple(w[i:i + rule.words]) for i in range(len(w) - rule.words + 1)} or ({tuple(w)} if w else set())
    comp = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                lo, hi = sorted((comp[a], comp[b]))
                comp = {d: lo if c == hi else c for d, c in comp.items()}
    got = shingle_join.shingle_components(docs, rule).collect()
    assert len(got) == len(rows) and len({comp[d] for d in comp}) < len(comp)
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), comp[r.doc_id]) for r in got)
    kept = shingle_join.keep_representatives(docs, rule)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(comp.values())
    assert shingle_join.shingle_components(nothing, rule).count() == 0


def test_warc(spark, nothing):
    rows = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "z" * 3_000_000), (6, "u", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    payloads = {r[0]: (r[2] or "").encode() for r in rows}
    for least in (0, 1):
        got = {r.page_id: r for r in warc.pages_through_archive(pages, least).collect()}
        assert len(got) == len(rows)
        for i, p in payloads.items():
            first = max(j for j, q in payloads.items() if q == p)
            again = first != i and len(p) >= least
            assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (
                len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first if again else None)
    assert warc.pages_through_archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_predicates_reach_the_reader(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([(i, f"http://h/{i}", "same" if i % 2 else str(i)) for i in range(10)], "page_id long, url string, html string")
    warc.archive(pages, str(tmp_path / "a"))
    back = spark.read.format("warc").option("path", str(tmp_path / "a")).load()
    assert back.where("record_type = 'revisit'").count() == 4
    one = back.where("target_uri = 'http://h/4'").collect()
    assert [bytes(r.payload) for r in one] == [b"4"]
    reader = warc.WarcReader({"path": str(tmp_path / "a")})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    assert len(list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 1)]))) == 1
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 4


def test_warc_appends_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "a")
    for ids in (range(3), range(3, 7)):
        warc.archive(spark.createDataFrame([(i, f"http://h/{i}", f"body {i}") for i in ids], "page_id long, url string, html string"), path)
    back = spark.read.format("warc").option("path", path).load()
    assert sorted(bytes(r.payload) for r in back.collect()) == [f"body {i}".encode() for i in range(7)]
    one = spark.createDataFrame(back.where("target_uri = 'http://h/4'").collect(), warc.SCHEMA)
    one.write.format("warc").mode("overwrite").option("path", path).save()
    assert [bytes(r.payload) for r in spark.read.format("warc").option("path", path).load().collect()] == [b"body 4"]
    one.write.format("warc").mode("append").option("path", path).save()
    assert spark.read.format("warc").option("path", path).load().count() == 2


def test_mixing(docs, rows, nothing):
    got = mixing.mix(docs, mixing.lexical_quality("text")).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), mixing.lexical_quality("text")).collect()))
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    of = {r[0]: r[3] for r in rows}
    total = collections.Counter()
    for r in rows:
        total[r[3]] += size[r[0]]
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, budget = {}, set(order), 1.5 * sum(total.values())
    while True:
        each = budget / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * each > 2 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * total[s]
            budget -= target[s]
            left.discard(s)
    target |= {s: weight[s] * each for s in left}
    taken = collections.Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == total[of[r.doc_id]] and r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(target[of[r.doc_id]])
        taken[of[r.doc_id]] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(size[d] for d in size if of[d] == s)
    assert mixing.take(docs, mixing.mix(docs)).columns == docs.columns
    assert mixing.mix(nothing).count() == 0


def test_mixing_slices_stay_small_under_any_weights(spark):
    from pyspark.sql import functions as F

    n = 100_000
    for quality in (F.lit(1.0), F.lit(0.02), F.lit(1e-6), F.when(F.col("id") % 3 == 0, 0.001).otherwise(0.9)):
        cut = spark.range(n).select((-F.log(F.rand(4)) / quality).alias("key"))
        cut = cut.select("key", mixing.slice_of(F.col("key"), n // mixing.SLICE_ROWS + 1).alias("slice"))
        per = cut.groupBy("slice").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("slice").collect()
        assert max(r.n for r in per) <= mixing.SLICE_ROWS and sum(r.n for r in per) == n
        assert all(a.hi <= b.lo for a, b in zip(per, per[1:]))


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[0][1]) for i in range(20)]  # ties
    vectors += [(400, None), (401, [float("nan")] * 8), (402, [None] * 8), (450, [float("inf")] * 8), (403, [1.0, 2.0]), (500, []), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, score string").repartition(3)
    weights = {r.vec_id: [int(np.floor(256 * float(x))) for x in r.embedding] for r in frame.collect()
               if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)}
    want = set()
    for q in (v for v in weights if v % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(weights[q], weights[c])), c) for c in weights if c != q)
        want |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(scored[:5])}
    got = topk.top_k(frame, frame["vec_id"] % 50 == 0).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    huge = spark.createDataFrame([(0, [3e30]), (1, [2e30]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert [r.score for r in topk.top_k(huge, huge["vec_id"] == 0).orderBy("rank").collect()][0] == (1 << 63) - 1
    assert topk.top_k(frame.limit(0), frame["vec_id"] % 50 == 0).count() == 0


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_language(docs, rows, nothing, real):
    model = language.fit(real[0])
    out = language.predict(real[0], model).join(real[0].select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in out) > 0.97 * len(out)
    got = language.predict(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if not re.search(r"[^\W\d_]", dict((x[0], x[1]) for x in rows)[r.doc_id] or ""))
    assert language.predict(nothing, model).count() == 0
    assert {r.lang_pred for r in language.predict(docs, language.fit(nothing)).collect()} == {"und"}


def test_quality(docs, rows, nothing, real):
    model = quality.fit(*real)
    out = quality.score(real[0], model).join(real[1], "doc_id").where("held_out").collect()
    assert sum(r.quality == r.predicted for r in out) > 0.95 * len(out)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(nothing, model).count() == 0
    assert quality.score(docs, quality.fit(nothing, real[1])).count() == len(rows)


def test_exact_dedup(docs, rows, nothing):
    norm = {r[0]: re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows}
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm[r[0]]].append(r[0])
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        own = groups[norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.text_sha256) == (min(own), len(own), hashlib.sha256(norm[r.doc_id].encode()).hexdigest())
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "same text " * 20), (4, "same text " * 20), (None, "same text " * 20)], "doc_id long, text string")
    assert sorted((r.keep_id, r.kept) for r in exact_dedup.exact_dedup(docs).collect()) == [(4, False), (4, False), (4, True)]
    assert sorted(r.n_removed for r in suffix_dedup.dedup_substrings(docs).collect()) == [0, 200, 200]
    assert {r.component_id for r in shingle_join.shingle_components(docs).collect()} == {None, 4}


def test_packing_word_cache_gives_the_tokenizers_ids(monkeypatch):
    """Plain letters, marks, special tokens, other scripts; with generations of 50 words that turn over."""
    import random

    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "_CACHE_WORDS", 50)
    words, whole = packing._Words(word_tokenizer()), Tokenizer.from_file(word_tokenizer())
    rnd = random.Random(11)
    signs = "aAbZ éß,.;:!?%&)('s't're'll<|> 9１½中가ǅᾴ̸_-‍😀 \t\n"
    for i in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 24))) + ("<|endoftext|>and, " if i % 9 == 0 else "")
        got = np.frombuffer(packing.tokens(text.encode(), words), "<u4").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, text
    assert len(words) <= 50 and len(words.old) <= 50
