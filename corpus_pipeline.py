"""The corpus pipeline: raw documents -> quality rules -> near-dedup -> decontamination -> mix of sources -> shards.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netsieve.llm import decontaminate, mixing, quality, sharding, simhash
from netsieve.llm.queries import find_package
from netsieve.operators.sizing import checkpoint_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules."""
    find_package(spark)
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    find_package(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    find_package(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: some twice, some in part, some not."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.placement(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: SQL cannot express the stages' hashes and edit search; tests/llm holds run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = checkpoint_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
