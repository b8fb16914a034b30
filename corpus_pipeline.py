"""A corpus pipeline of five stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldwatch.llm import packing, pii, quality, simhash, substring
from fieldwatch.llm.common import new_path, ship, table
from fieldwatch.llm.queries import SURROGATE_KEY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies."""
    ship(spark)
    return simhash.keep_first(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller doc_id has."""
    ship(spark)
    return substring.remove_repeats(docs)


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data."""
    ship(spark)
    return pii.with_surrogates(docs, SURROGATE_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of fixed-size training sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good),
    ("near copies", distinct),
    ("repeated passages", unrepeated),
    ("personal data", anonymous),
    ("packing", packed),
]

#: Most stages have no SQL form (fingerprints, tokens, surrogates); tests hold the result against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
