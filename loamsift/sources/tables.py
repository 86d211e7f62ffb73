"""The given parquet tables as sources of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamsift.config import SourceSpec
from loamsift.sources.documents import scan, to_raw

# First number of the sources of each domain, for sources named src<number>.
DOMAIN_STARTS = (("academic", 19), ("news", 16), ("code", 13), ("books", 8), ("web", 0))

# Text column and id of each table that serves as a source.
TABLE_SOURCES = (
    (SourceSpec("conversations", "conversations", None, "train", "text", 0.0, 0), "conv_id"),
    (SourceSpec("benchmark", "benchmark", None, "train", "text", 0.0, 0), "item_id"),
    (SourceSpec("pages", "pages", None, "train", "html", 0.0, 0), "page_id"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a scan with splits for less than half of the cores out to all of them. A large scan is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if 2 * df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` with its domain: (doc_id, text, domain, source, language, title)."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    domain = F.lit(None).cast("string")
    for name, start in reversed(DOMAIN_STARTS):
        domain = F.when(number >= start, name).otherwise(domain)
    return spread(table(spark, folder, "documents").drop("n_chars"), "doc_id").select(
        "doc_id",
        "text",
        domain.alias("domain"),
        "source",
        F.col("lang").alias("language"),
        F.lit(None).cast("string").alias("title"),
    )


def raw_documents(spark: SparkSession, folder: str, keep_stats: bool = False) -> DataFrame:
    return to_raw(documents(spark, folder), keep_stats)


def other_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [scan(table(spark, folder, spec.dataset), spec, id_column) for spec, id_column in TABLE_SOURCES]
