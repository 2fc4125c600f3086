"""Queries on vectors and models: embedding near-dedup, quality, language-model scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import lm_score, quality
from tidemark.llm.registry import query, table
from tidemark.llm.vectors import near_vectors


@query("op9_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors, cosine 0.95."""
    return near_vectors(table(spark, folder, "embeddings"))


@query("op10_lm_score")
def lm_score_query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; one in ten held out."""
    return lm_score.score(table(spark, folder, "documents"))


@query("op7_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document judged."""
    return quality.judge(table(spark, folder, "documents"))
