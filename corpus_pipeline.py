"""The corpus pipeline: five stages over documents, each reading what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from texmend.llm import decontaminate, jaccard, mixing, quality, shards
from texmend.llm.work import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of those with five-word shingle similarity of at least 0.8, that with the smallest doc_id."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, from the shards written."""
    return shards.materialised(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-id / binary output", training_order),
]

#: SQL can express neither the suffix-array rule nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
