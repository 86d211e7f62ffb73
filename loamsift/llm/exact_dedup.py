"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are compared without their white space. One scan notes the length and a hash of the first
characters of every text; the only thing shuffled is one count per (length, prefix) and task. A
text whose length, or length and prefix, nobody shares is settled there. The second scan hashes the
full content of the texts that are left, and only their digests are grouped.

Defined cases: a null text counts as empty, so null, empty and blank texts are copies of each
other. Of equal texts the longest original stays, then the smallest ``doc_id``; a null ``doc_id``
comes last. Rows that repeat a ``doc_id`` are separate rows, and exactly one row of a group is kept.
An empty table gives no rows. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamsift.llm.common import boxed, small_side, text_of, without_space
from loamsift.operators.staging import stage

PREFIX_CHARS = 64


def exact_groups(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept`` and ``level``, which settled it.

    ``extra`` names further columns to compute from ``text`` while it is being read.
    """
    extra = extra or {}
    plain = without_space(text_of())
    sized = docs.select(
        "doc_id",
        *[value.alias(name) for name, value in extra.items()],
        F.length(text_of()).alias("_points"),
        plain.alias("_plain"),
    ).withColumns({
        "_length": F.length("_plain"),
        "_prefix": F.xxhash64(F.substring("_plain", 1, PREFIX_CHARS)),
    })
    prefixes = stage(sized.groupBy("_length", "_prefix").agg(F.count("*").alias("_rows")), "op4_prefixes")
    # The first two levels: prefixes that are alone under their length are done; a length all of
    # whose rows are one is too.
    shared = prefixes.where(F.col("_rows") > 1).select("_length", "_prefix", F.lit(True).alias("_shared"))
    read = stage(
        sized.join(small_side(shared), ["_length", "_prefix"], "left").select(
            "doc_id", *extra, "_points", "_length",
            F.when(F.col("_shared"), F.sha2("_plain", 256)).alias("_full"),
        ),
        "op4_read",
    )
    alone = read.where("_full IS NULL").select(
        "doc_id", *extra, F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.lit("prefix").alias("level"),
    )
    hashed = read.where("_full IS NOT NULL").drop("_length")
    groups = hashed.groupBy("_full").agg(
        F.count("*").alias("group_size"), F.max(F.struct("_points", (-F.col("doc_id")).alias("_minus"))).alias("_best")
    ).select("_full", "group_size", F.col("_best._points").alias("_most"), (-F.col("_best._minus")).alias("keep_id"))
    groups = stage(groups, "op4_groups")  # written, so that a large group can be split in the join
    verdicts = stage(
        hashed.join(groups, "_full").withColumn(
            "_wins", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_points") == F.col("_most"))
        ),
        "op4_verdicts",
    )
    # Winners are one row a group, or the repeats of one row: the window never sees a group of copies.
    turn = F.row_number().over(Window.partitionBy("_full").orderBy("_points"))
    names = ["doc_id", *extra, "keep_id", "group_size"]
    winners = verdicts.where("_wins").select(*names, (turn == 1).alias("kept"), F.lit("full").alias("level"))
    losers = verdicts.where("NOT _wins").select(*names, F.lit(False).alias("kept"), F.lit("full").alias("level"))
    return alone.unionByName(winners).unionByName(losers)


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that exact dedup keeps: one row of each group of equal texts."""
    hashed = boxed(docs, "doc_id", F.xxhash64(text_of()).alias("_text_hash"))
    kept = stage(
        exact_groups(docs, {"_text_hash": F.xxhash64(text_of())}).where("kept").select("doc_id", "_text_hash"),
        "op4_kept",
    ).toDF("_doc", "_hash")
    # Each kept row is the only one of its text, so the text's hash and its id name it.
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    rows = hashed.join(kept.hint("shuffle_hash"), same, "left_semi")
    repeats = docs.groupBy("doc_id").count().where("count > 1").head(1)
    if repeats:
        rows = rows.dropDuplicates(["doc_id", "_text_hash"])
    return rows.select("_row.*")
