"""Dense ranks without gathering the rows in one task.

A window without ``partitionBy`` sorts everything in one task, and one partitioned by
a domain puts a third of the corpus in one. Here the rows are range-partitioned and
sorted by a unique key, each row notes its place in its partition, and the only thing
summed up in order is one count per partition (and group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamsift.operators.staging import stage

_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in its low 33 bits


def add_rank(
    df: DataFrame, order: list[Column], name: str = "rank", within: str | None = None, start: int = 0
) -> DataFrame:
    """Add a dense ``name`` column counting from ``start`` by ``order``, per ``within`` if given.

    ``order`` must end in a unique column. Pass narrow rows: they are sorted and written once.
    """
    group = [F.col(within)] if within else []
    placed = stage(
        df.orderBy(*group, *order).withColumn("_id", F.monotonically_increasing_id()), "ranked"
    ).select(
        *df.columns,
        F.shiftright("_id", _PLACE_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )
    keys = ([within] if within else []) + ["_part"]
    sizes = placed.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    # One row per partition, or per partition and group: never a row per document.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if within:
        earlier = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    if not within:
        offsets = F.broadcast(offsets)  # one row per partition; with groups the planner decides
    rank = (F.col("_place") + F.col("_offset") + F.lit(start)).cast("bigint")
    return placed.join(offsets, keys).select(*df.columns, rank.alias(name))


def top_fraction(df: DataFrame, score: str, rate: float, key: str = "doc_id", within: str | None = None) -> DataFrame:
    """The ``floor(n * rate)`` best rows by (score desc, key), with a 0-based ``selection_rank``."""
    ranked = add_rank(df, [F.col(score).desc(), F.col(key)], "selection_rank", within)
    if within is None:
        keep = int(df.count() * rate)
        return ranked.where(F.col("selection_rank") < keep)
    sizes = stage(
        df.groupBy(within).agg(F.floor(F.count("*") * F.lit(rate)).alias("_keep")), "group_sizes"
    )
    return ranked.join(sizes, within).where(F.col("selection_rank") < F.col("_keep")).drop("_keep")
