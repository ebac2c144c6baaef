"""The registered queries of this subpackage: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netsieve.llm import blocks, decontaminate, mixing, ngrams, parsing, phrases, prefixes, quality, repair, sharding, simhash, tokens, toxicity
from netsieve.llm.oracles import ORACLES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed: its folder goes into their search path."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, known) if p)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.repeated_phrases(table(spark, sf, "documents"), with_text=False)


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.placement(table(spark, sf, "documents"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op5_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.repeated_substrings(table(spark, sf, "documents"), with_text=False)


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).drop("source")


def op10_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.extract_text(table(spark, sf, "pages"))


def op11_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.language_scores(table(spark, sf, "documents"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.conversation_trie(table(spark, sf, "conversations"), rebuild=True)


def op13_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_decontamination, op2_substring_dedup, op3_sharding, op4_simhash, op5_suffix_array, op6_token_counts, op7_quality, op8_toxicity,
        op9_mixing, op10_html_extraction, op11_lm_scoring, op12_prefix_trie,
        op13_structure_repair,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
