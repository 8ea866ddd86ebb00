"""From raw documents to packed sequences: five stages, each with an operator of ``matchlore.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlore.llm import mixing, packing, quality, simhash, suffixes
from matchlore.llm.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within three bits."""
    return simhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 200 bytes that are found elsewhere."""
    return suffixes.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their place in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("mixing", source_mix),
    ("packing", pack),
]

#: Suffix orders, near-duplicate components and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
