"""Queries of the text operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm import (
    conversations,
    exact_dedup,
    language,
    lexical,
    mixing,
    ngram_join,
    quality,
    quotations,
    sentence_pieces,
    spotsigs,
    substrings,
    toxicity,
    urls,
)
from ratingloom.llm.common import table


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"))


def op3_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.linked(table(spark, folder, "conversations"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))


def piece_model() -> str:
    """The model file of the public tokenizers; SENTENCEPIECE_MODEL names another."""
    return os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op7_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    pieces = sentence_pieces.Pieces.load(piece_model())
    return sentence_pieces.encoded(table(spark, folder, "documents"), pieces)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, folder, "documents"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(table(spark, folder, "documents"))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, folder, "labels")))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_plans(conversations.damaged(table(spark, folder, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_quotation_links": op3_quotation_links,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_fingerprints": op8_fingerprints,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_quality": op11_quality,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_repair": op13_conversation_repair,
}
