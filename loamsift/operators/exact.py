"""Exact duplicates: the first document of each distinct text survives.

Only (hash, id) is shuffled to find the survivors, with partial aggregation, so a text
copied into a third of the corpus costs one row per map task. The ids to drop are then
taken out of the texts; where ids repeat, texts are joined to the ids that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loamsift.functions.text import content_hash
from loamsift.operators.keyed_join import spread_join
from loamsift.operators.seen import SeenHashes
from loamsift.operators.staging import stage


def with_hash(df: DataFrame, hash_type: str = "md5") -> DataFrame:
    return df.withColumn("hash_id", content_hash(F.col("text"), hash_type))


def first_ids(hashed: DataFrame, keep: str = "first") -> DataFrame:
    """(hash_id, doc_id of its first (or last) document, number of documents)."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
    end = F.min if keep == "first" else F.max
    return hashed.groupBy("hash_id").agg(end("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def exact_dedup(df: DataFrame, hash_type: str = "md5", keep: str = "first") -> DataFrame:
    hashes = stage(with_hash(df, hash_type).select("doc_id", "hash_id"), "hashes")
    survivors = first_ids(hashes, keep).select("doc_id", "hash_id")
    ids = hashes.where(F.col("doc_id").isNotNull())
    if ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        # The dropped ids are few and written, so the planner sees whether it can do without moving the texts.
        dropped = stage(ids.join(survivors, "doc_id", "left_anti").select("doc_id"), "exact_dropped")
        others = [name for name in df.columns if name not in ("doc_id", "hash_id")]
        known = with_hash(df, hash_type).where(F.col("doc_id").isNotNull()).select("doc_id", *others, "hash_id")
        kept = known.join(dropped, "doc_id", "left_anti")
    else:
        kept = df.join(survivors, "doc_id")
    return kept.withColumn("is_duplicate", F.lit(False))


def exact_dup_flags(df: DataFrame, hash_type: str = "md5") -> DataFrame:
    """Every input row, marked."""
    hashed = with_hash(df, hash_type)
    survivors = first_ids(hashed.select("doc_id", "hash_id")).select("doc_id", F.lit(True).alias("_first"))
    return (
        hashed.join(survivors, "doc_id", "left")
        .withColumn("is_duplicate", F.col("_first").isNull())
        .drop("_first")
    )


def exact_dup_audit(df: DataFrame, hash_type: str = "md5") -> DataFrame:
    """(doc_id, hash_id, first_doc_id) of every dropped document."""
    hashed = stage(with_hash(df, hash_type).select("doc_id", "hash_id"), "hashes")
    groups = stage(first_ids(hashed).where(F.col("copies") > 1), "copied_hashes")
    firsts = groups.select("hash_id", F.col("doc_id").alias("first_doc_id"))
    counts = groups.select("hash_id", F.col("copies").alias("_rows"))
    return spread_join(hashed, firsts, "hash_id", "doc_id", counts=counts).where(
        F.col("doc_id") > F.col("first_doc_id")
    )


def exact_dedup_incremental(batch: DataFrame, seen: DataFrame | None, hash_type: str = "md5") -> DataFrame:
    """Survivors of ``batch`` given the (hash_id) table of everything kept before."""
    firsts = first_ids(with_hash(batch, hash_type).select("doc_id", "hash_id"))
    if seen is not None:
        firsts = firsts.join(seen.select("hash_id"), "hash_id", "left_anti")
    return batch.join(firsts.select("doc_id", "hash_id"), "doc_id").withColumn(
        "is_duplicate", F.lit(False)
    )


def exact_dedup_with_store(batch: DataFrame, store: SeenHashes, number: int, hash_type: str = "md5") -> DataFrame:
    """Survivors of ``batch`` given the batches before ``number`` in ``store``.

    Add their ``hash_id`` to the store once they are written. Only hashes are compared; the text follows by id.
    """
    firsts = stage(first_ids(with_hash(batch, hash_type).select("doc_id", "hash_id")).select("doc_id", "hash_id"), "batch_firsts")
    new = firsts.join(store.seen(firsts.select("hash_id"), number), "hash_id", "left_anti")
    return batch.join(new.select("doc_id", "hash_id"), "doc_id").withColumn("is_duplicate", F.lit(False))
