"""The queries of this subpackage over the given tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newslake.llm import (
    alignment,
    chat_tools,
    decontaminate,
    importance,
    language,
    mixing,
    near_dedup,
    packing,
    quality_mil,
    quality_votes,
    suffix_dedup,
    token_counts,
    toxicity,
)
from newslake.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def op1_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_tools.link(*chat_tools.logged_calls(table(spark, sf_dir, "conversations")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_mil.score(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), language.fit(docs)))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.judge(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_chat_tools, op2_suffix_dedup, op3_quality_mil, op4_toxicity, op5_language, op6_token_counts,
              op7_quality_votes, op8_near_dedup, op9_decontaminate, op10_mixing, op11_importance, op12_packing, op13_alignment)
} | {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {"op9_decontaminate": decontaminate.SQL, "op11_importance": importance.SQL}
