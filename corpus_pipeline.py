"""Corpus pipeline: quality rules, exact dedup, n-gram Jaccard join, mixing, SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerbench.llm import exact_dedup, mixing, ngram_join, quality, sentencepiece_codec
from peerbench.llm.common import read
from peerbench.llm.queries import MODEL_FILE
from peerbench.session import durable


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules reject."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def unlinked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return ngram_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate takes it."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each copy of each document; the model file stands outside the data."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.Model.load(MODEL_FILE))


STAGES = [
    ("quality_rules", good),
    ("exact_dedup", distinct),
    ("ngram_jaccard_join", unlinked),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]
#: SQL states neither the near copies nor the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
