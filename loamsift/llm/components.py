"""Connected components by alternating large-star and small-star rounds.

Each round hangs a node's neighbours on the smallest node it knows. The number of rounds grows with
the logarithm of the longest chain, and no round emits more edges than it got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loamsift.operators.staging import stage


def _hung(edges: DataFrame) -> DataFrame:
    """Hang the neighbours ``b`` of every ``a`` on the smallest of them, or on ``a`` if it is smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return edges.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a``, ``b``); ``label`` is its component's smallest node."""
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hung(both).where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
        small = _hung(stage(large, "large_star"))
        small = small.select("a", F.col("_m").alias("b")).unionByName(small.where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b")))
        now = stage(small.where("a <> b").distinct(), "small_star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
