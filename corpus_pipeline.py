"""From raw documents to token ids: five stages, each applying one corpus operator to all its input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.containment import decontaminate
from tidemark.llm.ngram_join import similar_classes
from tidemark.llm.quality import keep_good
from tidemark.llm.registry import table
from tidemark.llm.secret_scan import mask_secrets
from tidemark.llm.sentencepiece_scan import round_trip
from tidemark.llm.storage import stored

MODEL = "piece_bpe_32k.model"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return keep_good(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the smallest id stays; rows without an id stay."""
    rest = similar_classes(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` follows the text. All documents stay."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of what they decode to."""
    return round_trip(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

# The classifier, the model's ids and the similarity classes have no SQL form; tests/llm holds the brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
