"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual`` points on a ring of 2^63 places; a document belongs to the next point
clockwise from the hash of its id. A shard takes its own documents up to its capacity, in ring
order; what is over continues clockwise to the next points whose shards still have room.

Only the ring order matters for that, so nothing is decided document by document: documents are
range-partitioned by their place and ranked, counts per point (a table bounded by ``shards x
virtual``) say how many each point keeps and passes on, and the answer is a table of rank intervals.
A third of all documents behind one point is just a long interval.

With no ``slack`` the capacities add up to the number of documents and differ by one at most, so
counts do too; with ``slack`` fewer documents move when a shard is added and loads stay below
``(1 + slack)`` times the mean.

Defined cases: a null text has no bytes. A document without id is placed by its text. Repeated
rows take neighbouring places. An empty table gives no rows. Of other columns ``shard`` and
``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loamsift.llm.common import boxed, text_of
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import stage

VIRTUAL = 128
CELL_BITS = 12  # the ring in so many equal cells, each with the points in it
RING_BITS = 63
OVERHEAD = 8  # bytes a document takes besides its text


def _place(*columns):
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - RING_BITS)


def ring_points(spark: SparkSession, shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(place, shard) of all points in ring order: as many rows as the parameters say, whatever the data."""
    points = spark.range(shards * virtual).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("copy")
    )
    rows = points.select(_place(F.lit("point"), "shard", "copy").alias("place"), "shard").collect()
    return sorted((row["place"], row["shard"]) for row in rows)


def sized_documents(docs: DataFrame) -> DataFrame:
    """Narrow rows: ``doc_id, size`` in bytes, ``text_crc32`` and the ring place."""
    text = F.encode(text_of(), "UTF-8")
    crc = F.crc32(text)
    return docs.select(
        "doc_id", (F.octet_length(text_of()) + OVERHEAD).cast("bigint").alias("size"), crc.cast("bigint").alias("text_crc32")
    ).withColumn("_ring", F.when(F.col("doc_id").isNull(), _place("text_crc32")).otherwise(_place("doc_id")))


def _intervals(points: list[tuple[int, int]], counts: list[int], shards: int, slack: float) -> list[tuple[int, int, int, int]]:
    """(point, first rank, end rank, shard) of the documents that a point keeps or passes on."""
    rows = sum(counts)
    if slack:
        room = [-int(-(1 + slack) * rows // shards)] * shards
    else:
        room = [rows // shards + (shard < rows % shards) for shard in range(shards)]
    found, waiting, rank = [], [], 0
    for point, (_, shard) in enumerate(points):
        keeps = min(counts[point], room[shard])
        room[shard] -= keeps
        if keeps:
            found.append((point, rank, rank + keeps, shard))
        waiting.append((point, rank + keeps, rank + counts[point]))
        rank += counts[point]
    queue: list[tuple[int, int, int]] = []
    for turn in range(2):  # all overflow has met every shard after the second turn
        for point, (_, shard) in enumerate(points):
            while queue and room[shard]:
                origin, first, end = queue[0]
                takes = min(end - first, room[shard])
                found.append((origin, first, first + takes, shard))
                room[shard] -= takes
                queue[0] = (origin, first + takes, end)
                if first + takes == end:
                    queue.pop(0)
            if turn == 0 and waiting[point][1] < waiting[point][2]:
                queue.append(waiting[point])
    return sorted(found)


def assign_shards(sized: DataFrame, shards: int, virtual: int = VIRTUAL, slack: float = 0.0) -> DataFrame:
    """``sized`` (with ``_ring``) with ``shard`` and a gapless ``slot`` in it."""
    spark = sized.sparkSession
    points = ring_points(spark, shards, virtual)
    shift = RING_BITS - CELL_BITS
    cells: list[list[tuple[int, int]]] = [[] for _ in range(1 << CELL_BITS)]
    for number, (place, _) in enumerate(points):
        cells[place >> shift].append((place, number))
    following, rows = 0, []
    for cell in reversed(range(len(cells))):
        rows.append((cell, cells[cell], following))
        following = cells[cell][0][1] if cells[cell] else following
    ring = F.broadcast(spark.createDataFrame(rows, "_cell int, _points array<struct<place: bigint, point: int>>, _next int"))
    inside = F.filter("_points", lambda p: p["place"] >= F.col("_ring"))
    pointed = stage(
        sized.withColumn("_cell", F.shiftright("_ring", shift).cast("int"))
        .join(ring, "_cell")
        .withColumn("_point", F.coalesce(F.get(inside, F.lit(0))["point"], F.col("_next")))
        # Places behind the last point belong to point 0, ahead of its own documents.
        .withColumn("_wrapped", (F.col("_point") != 0) | (F.col("_ring") <= F.lit(points[0][0])))
        .drop("_cell", "_points", "_next"),
        "op7_pointed",
    )
    counted = {row["_point"]: row["count"] for row in pointed.groupBy("_point").count().collect()}  # a row per point
    order = [F.col("_point"), F.col("_wrapped"), F.col("_ring"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranked = add_rank(pointed, order, "_rank")
    found = _intervals(points, [counted.get(number, 0) for number in range(len(points))], shards, slack)
    used, table = [0] * shards, {}
    for point, first, end, shard in found:
        table.setdefault(point, []).append((first, end, shard, used[shard] - first))
        used[shard] += end - first
    plan = F.broadcast(spark.createDataFrame(
        list(table.items()), "_point int, _parts array<struct<first: bigint, end: bigint, shard: int, shift: bigint>>"
    ))
    part = F.get(F.filter("_parts", lambda p: (p["first"] <= F.col("_rank")) & (F.col("_rank") < p["end"])), F.lit(0))
    names = [name for name in sized.columns if name.lower() not in ("shard", "slot", "_ring")]
    return (
        ranked.join(plan, "_point")
        .withColumn("_part", part)
        .select(*names, F.col("_part.shard").alias("shard"), (F.col("_rank") + F.col("_part.shift")).alias("slot"))
    )


def write_shards(docs: DataFrame, path: str, shards: int, virtual: int = VIRTUAL, slack: float = 0.0) -> None:
    """Write ``docs`` as one folder per shard, rows in slot order. Text moves once, to its shard.

    Rows that share id and text are told apart by their number among themselves.
    """
    key = ["doc_id", "text_crc32", "size"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    placed = assign_shards(sized_documents(docs), shards, virtual, slack).withColumn("_number", number)
    text = F.crc32(F.encode(text_of(), "UTF-8")).alias("_crc")
    rows = boxed(docs.drop("shard", "slot"), "doc_id", text, (F.octet_length(text_of()) + OVERHEAD).cast("bigint").alias("_size"))
    rows = rows.withColumn("_number", F.row_number().over(Window.partitionBy("doc_id", "_crc", "_size").orderBy(F.lit(0))))
    placed = placed.withColumnRenamed("doc_id", "_doc").withColumnRenamed("_number", "_turn")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_crc") == F.col("text_crc32"))
        & (F.col("_size") == F.col("size")) & (F.col("_number") == F.col("_turn"))
    )
    rows.join(placed, same).select("_row.*", "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
