"""The operators as queries over whole tables: name -> f(spark, sf_dir), and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldwatch.llm import bpe, collocations, covertree, html_text, link_trust, packing, pii, prefix_trie, quality, simhash, substring, toxicity, warc
from fieldwatch.llm.common import table


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op4_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_cover_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"))


def op6_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_report(table(spark, sf_dir, "documents"))


def op9_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: A deployment passes its own secret; this one makes the registered query repeatable.
SURROGATE_KEY = b"a registered query's public key"


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogate_report(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.verdicts(table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_bundles": op1_warc_bundles,
    "op2_main_text": op2_main_text,
    "op3_rule_ledger": op3_rule_ledger,
    "op4_simhash_tiles": op4_simhash_tiles,
    "op5_cover_trees": op5_cover_trees,
    "op6_toxic_neighbours": op6_toxic_neighbours,
    "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_chunked_bpe": op9_chunked_bpe,
    "op10_surrogates": op10_surrogates,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_link_trust": op12_link_trust,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_rule_ledger": quality.REPORT_SQL,
    "op5_cover_trees": covertree.TOP_K_SQL,
    "op11_phrase_collocations": collocations.COLLOCATIONS_SQL,
    "op12_link_trust": link_trust.VERDICTS_SQL,
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
}
