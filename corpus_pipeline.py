"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metroloom.llm import _shared as sh
from metroloom.llm import exact_dedup, near_dup, packing, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs, words=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, sh.tokenizer_path("byte_bpe_50k.json"), window=1024, end_id=0)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage), ("packing", packing_stage)]

#: SQL cannot tokenize, hash signatures or train: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = sh.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
