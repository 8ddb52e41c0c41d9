"""Training-corpus pipeline over ``documents``: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
all rows its predecessor kept.  All but the last return the columns of
``documents``, whatever further columns there are and however they are named.

The same rules hold in every stage: a null text counts as empty (the
classifier scores empty texts too, near copies never link them); a null doc_id
is a document of its own and counts as larger than any other; a null source is
a source of its own; texts are taken whole at any length.  Rows that repeat
doc_id and text are exact copies: one stays, the one with the smallest hash of
the whole row.  An empty ``documents`` gives an empty result; without labels
the classifier scores 0.5 and rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parchment.llm import exact_dedup, mixing, packing, quality, shingle_join
from parchment.llm.common import read, stage
from parchment.llm.queries import word_tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near copies the document with the smallest doc_id stays."""
    return shingle_join.keep_representatives(docs, shingle_join.STAGE_RULE)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents as often as the mix takes them (none, once or twice)."""
    return mixing.take(docs, mixing.mix(docs, mixing.lexical_quality("text")))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the packed sequences' pieces."""
    return packing.pack(docs, word_tokenizer())


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("mix", mix_stage), ("pack", pack_stage)]

ORACLE_SQL = None  # the classifier, the sampling keys and the tokenizer are outside SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's docs."""
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
