"""JSON-lines sinks. Parquet stays the working format between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_jsonl(df: DataFrame, path: str, by: str | None = None, mode: str = "errorifexists") -> None:
    """Write one folder of files, or one per value of ``by``."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(by)
    writer.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def finite_perplexity(df: DataFrame) -> DataFrame:
    """JSON has no infinity: the perplexity of blank text is written as null."""
    ppl = F.col("metadata.perplexity")
    return df.withColumn(
        "metadata", F.col("metadata").withField("perplexity", F.when(ppl < F.lit(float("inf")), ppl))
    )
