"""Lines that many documents share, dropped by range-partitioned hashes and keep bitmaps.

Each long line becomes (hash, document, positions). The hashes are range-partitioned by hash *and*
document and sorted so, which spreads a line that a third of all documents hold over as many
partitions as its rows need. Every partition contributes one count and one last document per hash;
summed up by hash these say which lines go and who keeps them. Back comes, for each document that
loses lines, a run-length coded bitmap over its line numbers, never text.

Defined cases: a null or empty text is one empty line. A null ``doc_id`` comes before all others; where
all holders of a line have none, they all keep it. Rows that share id and text are one document: they count
once and share their verdict. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.llm.common import SPACE_CHARS, ascii_lower, boxed, text_of
from loamsift.operators.staging import stage

MIN_CHARS = 20
MIN_DOCS = 3
ROWS_PER_RANGE = 500_000


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """A row per document that loses lines: ``doc_id, _text_hash, dropped``.

    ``dropped`` holds the runs of zeros of the keep bitmap as (first line, last line), in order.
    """
    occurrences = stage(
        docs.select("doc_id", F.xxhash64(text_of()).alias("_text_hash"), F.posexplode(lines_of(text_of())).alias("_line", "_text"))
        .withColumn("_key", line_key(F.col("_text")))
        .where(F.length("_key") >= min_chars)
        .select("doc_id", "_text_hash", "_line", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")),
        "op8_lines",
    )
    holders = ["_h1", "_h2", "doc_id", "_text_hash"]
    ranges = max(1, -(-occurrences.count() // ROWS_PER_RANGE))
    partitions = max(ranges, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = stage(
        occurrences.groupBy(*holders)
        .agg(F.collect_list("_line").alias("_lines"), F.min("_line").alias("_line"))
        .repartitionByRange(partitions, *holders)
        .sortWithinPartitions(*holders, "_line")
        .select(*holders, "_lines", F.spark_partition_id().alias("_range")),
        "op8_ordered",
    )
    slices = stage(
        ordered.groupBy("_range", "_h1", "_h2").agg(F.count("*").alias("_docs"), F.max("doc_id").alias("_last")), "op8_slices"
    )
    shared = slices.groupBy("_h1", "_h2").agg(F.sum("_docs").alias("_docs"), F.max("_last").alias("_keeper"))
    shared = shared.where(F.col("_docs") >= min_docs).drop("_docs")
    # By range and hash, a hot line's rows stay spread; each side of the join is bounded by a range.
    marked = slices.select("_range", "_h1", "_h2").join(shared, ["_h1", "_h2"])
    gone = ordered.join(marked, ["_range", "_h1", "_h2"]).where(~F.col("doc_id").eqNullSafe(F.col("_keeper")))
    lines = gone.groupBy("doc_id", "_text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_lines")))).alias("_l"))
    firsts = F.filter("_l", lambda x, i: (i == 0) | (F.get("_l", i - 1) != x - 1))
    lasts = F.filter("_l", lambda x, i: (i == F.size("_l") - 1) | (F.get("_l", i + 1) != x + 1))
    return lines.select("doc_id", "_text_hash", F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last"))).alias("dropped"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut by its bitmap; ``n_lines`` (before) and ``n_dropped`` are added, or replaced."""
    bitmaps = stage(bitmaps, "op8_bitmaps").withColumnsRenamed({"doc_id": "_doc", "_text_hash": "_hash", "dropped": "_runs"})
    hashed = boxed(docs.drop("n_lines", "n_dropped"), "doc_id", "text", F.xxhash64(text_of()).alias("_text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    joined = hashed.join(bitmaps.hint("shuffle_hash"), same, "left").withColumn("_lines", lines_of(text_of()))
    # Kept runs lie between the dropped ones: from the line after one to the line before the next.
    starts = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda run: run["last"] + 1))
    ends = F.concat(F.transform("_runs", lambda run: run["first"]), F.array(F.size("_lines")))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    kept = F.array_join(F.flatten(F.transform(runs, lambda run: F.slice(F.col("_lines"), run["a"] + 1, run["b"] - run["a"]))), "\n")
    gone = F.aggregate("_runs", F.lit(0), lambda n, run: n + run["last"] - run["first"] + 1)
    text = F.when(F.col("_runs").isNull(), text_of()).otherwise(kept)
    return joined.select(
        F.col("_row").withField("text", text).alias("_row"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("bigint").alias("n_dropped"),
    ).select("_row.*", "n_lines", "n_dropped")
