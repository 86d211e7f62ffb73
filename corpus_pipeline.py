"""Raw documents to packed training sequences: quality rules, exact and near dedup, mixing, packing.

Each stage takes what the one before it kept, as a written table, and hands on whole rows of
``documents``; the last one returns pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamsift.llm import exact_dedup, minhash, mixing, packing, quality
from loamsift.operators.staging import stage

ORACLE_SQL = None  # the fitted classifier of the first stage can't be told in SQL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier fitted on ``labels``."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_documents(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.survivors(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weight of its source asks for."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of one length."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
