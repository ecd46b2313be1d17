"""The queries of this package, with production parameters over whole tables, and their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, dedup, jaccard, lm, mixing, quality, secrets, shards, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.secrets(_table(spark, sf_dir, "documents")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.materialised(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixing(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.report(dedup.repeats(_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_warc, op3_shards, op4_quality, op5_decontaminate, op6_jaccard, op7_lm, op8_mixing, op9_toxicity, op10_dedup)}
ORACLE_SQL = {"op2_warc": warc.SQL, "op5_decontaminate": decontaminate.SQL, "op6_jaccard": jaccard.SQL, "op8_mixing": mixing.SQL}
