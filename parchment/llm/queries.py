"""The registered queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.llm import (exact_dedup, hard_negatives, hidden_markov, language, licenses, mixing, packing, prefix_trie, quality,
                           shingle_join, suffix_dedup, topk, warc)
from parchment.llm.common import read


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(read(spark, sf_dir, "documents"), width=50, with_text=False)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), word_tokenizer())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.shingle_components(read(spark, sf_dir, "documents"), shingle_join.QUERY_RULE)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_archive(read(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.lexical_quality("text")).select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op11_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=noisy)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_best_fit_packing, op3_license_scan, op4_ngram_jaccard_join, op5_warc, op6_mixing, op7_exact_topk_search, op8_language_id, op9_quality_classifier, op10_exact_dedup,
                                 op11_hmm_score, op12_hard_negatives, op13_prefix_trie)}

ORACLES = {
    "op7_exact_topk_search": """
        WITH flat AS (
            SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS term FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        v AS (SELECT vec_id, term, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM flat),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
            FROM v q JOIN v c ON q.term = c.term AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
        g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
        FROM n JOIN g USING (norm)""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        flat AS (SELECT vec_id, label, unnest(w) AS w, unnest(range(len(w))) AS term FROM v),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label, CAST(sum(a.w * c.w) AS BIGINT) AS score
            FROM flat a JOIN flat c ON a.term = c.term AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
            AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5""",
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, turn, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list(id || lpad(CAST(words AS VARCHAR), 8, '0') ORDER BY turn NULLS FIRST, id) AS seq FROM turns GROUP BY conv_id),
        shared AS (
            SELECT conv_id, seq, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
            FROM own),
        rebuilt AS (
            SELECT s.conv_id, list_concat(coalesce(b.seq, [])[1:s.h], s.seq[s.h + 1:]) AS seq
            FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 20),
        prefixes AS (
            SELECT conv_id, len(seq) AS size, unnest(range(len(seq) + 1)) AS depth, seq FROM rebuilt),
        nodes AS (
            SELECT array_to_string(seq[1:depth], '') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE CAST(right(any_value(seq[depth]), 8) AS BIGINT) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY 1, 2),
        families AS (SELECT left(path, len(path) - 72) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        counted AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f USING (path)),
        below AS (
            SELECT a.path, count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens
            FROM counted a JOIN counted b ON starts_with(b.path, a.path) GROUP BY a.path)
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves, b.saved_tokens, c.ends_sha256
        FROM counted c JOIN below b ON b.path = c.path
        LEFT JOIN counted p ON c.depth > 0 AND p.path = left(c.path, len(c.path) - 72)""",
}
