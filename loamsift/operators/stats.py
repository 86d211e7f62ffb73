"""Counts and means of the stage tables. All are small results of partial aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

CLASSES = ("high", "medium", "low")


def quality_distribution(processed: DataFrame) -> DataFrame:
    """(quality_class, count), with a row for every class even if it is empty."""
    classes = processed.sparkSession.createDataFrame([(c,) for c in CLASSES], "quality_class string")
    counts = processed.groupBy("quality_class").agg(F.count("*").alias("n"))
    return classes.join(counts, "quality_class", "left").select(
        "quality_class", F.coalesce("n", F.lit(0)).alias("count")
    )


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


def average_scores(processed: DataFrame) -> DataFrame:
    """(avg_quality_score, avg_toxicity_score), null without documents."""
    return processed.agg(
        F.avg("quality_score").alias("avg_quality_score"), F.avg("toxicity_score").alias("avg_toxicity_score")
    )


def raw_stats(raw: DataFrame) -> DataFrame:
    """One row: total_documents and the count of each domain as a map."""
    per_domain = count_by(raw.withColumn("domain", F.coalesce("domain", F.lit("unknown"))), "domain")
    return per_domain.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_documents"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("domain", "count")))).alias("domain_counts"),
    )


def processing_stats(processed: DataFrame) -> DataFrame:
    """One row: total, counts by class and domain, and mean scores, in one pass over the rows."""
    cells = processed.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain"), "quality_class").agg(
        F.count("*").alias("n"), F.sum("quality_score").alias("q"), F.sum("toxicity_score").alias("t")
    )
    domains = cells.groupBy("domain").agg(F.sum("n").alias("n"))
    by_domain = domains.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("domain", "n")))).alias("domain_distribution")
    )
    totals = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_processed"),
        F.struct(
            *[F.coalesce(F.sum(F.when(F.col("quality_class") == c, F.col("n"))), F.lit(0)).alias(c) for c in CLASSES]
        ).alias("quality_distribution"),
        F.try_divide(F.sum("q"), F.sum("n")).alias("avg_quality_score"),
        F.try_divide(F.sum("t"), F.sum("n")).alias("avg_toxicity_score"),
    )
    return totals.withColumn("_one", F.lit(1)).join(by_domain.withColumn("_one", F.lit(1)), "_one").drop("_one")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows), one row per named stage table."""
    rows = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)
