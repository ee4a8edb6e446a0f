"""Corpus pipeline: documents through the quality, deduplication, mixing and encoding operators, stage by stage.

Each stage works on all rows that its predecessor kept and returns the columns of documents; the last returns ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import exact_dedup, mixing, ngram_join, piece_sampling, quality_rules
from touchline.llm.common import staged, table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text stays."""
    return exact_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays."""
    return ngram_join.one_of_each_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go so that the domains' tokens meet their target weights."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document."""
    return piece_sampling.sample_pieces(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram join", near),
    ("mixing", mixture),
    ("piece sampling", encode),
]

#: The stages learn, sample and join by similarity; SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
