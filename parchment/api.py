"""Single-query entry points (the command-line shape of retrieval) over the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parchment.constants import DEFAULT_TOP_K, EMBEDDING_MODEL
from parchment.operators import retrieval


def _one(spark: SparkSession, query: str, agency=None, topic=None, document_type=None) -> DataFrame:
    return spark.createDataFrame([(1, query, agency, topic, document_type)],
                                 "query_id long, query_text string, agency string, topic string, document_type string")


def retrieve_text(spark: SparkSession, index: DataFrame, query: str, mode: str = "hybrid",
                  limit: int = DEFAULT_TOP_K, agency: str | None = None, topic: str | None = None,
                  document_type: str | None = None, model: str = EMBEDDING_MODEL,
                  postings: DataFrame | None = None) -> DataFrame:
    """D13 for one query string, with phrases, ``or`` and ``-word``: ranked rows with citations and the three scores."""
    q = _one(spark, query, agency, topic, document_type)
    return retrieval.retrieve(index, q, mode, limit, model, postings, syntax="web").orderBy("rank")


def search_text(spark: SparkSession, index: DataFrame, query: str, limit: int = DEFAULT_TOP_K,
                model: str = EMBEDDING_MODEL) -> DataFrame:
    """D11 for one query string: nearest chunks by cosine with a 360-character preview."""
    return retrieval.vector_search(index, _one(spark, query), limit, model).orderBy("rank")
