"""The row-local steps and exact dedup on a stream of document files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from loamsift.config import QualityConfig
from loamsift.operators import exact, quality
from loamsift.operators.seen import SeenHashes
from loamsift.sources.documents import length_filter, to_raw


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A folder of parquet files, taken a bounded number at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def dedup(stream: DataFrame, hash_type: str = "md5") -> DataFrame:
    """The first document to arrive of each text. What was seen is kept for good, as there is
    no event time after which a copy could not come; at scale use the RocksDB state store."""
    return exact.with_hash(stream, hash_type).dropDuplicates(["hash_id"])


def dedup_batches(stream: DataFrame, path: str, checkpoint: str, hash_type: str = "md5") -> StreamingQuery:
    """Exact dedup batch by batch into ``path``: of the copies in a batch the one with the smallest
    id survives, unless an earlier batch, also of an earlier run, had that text.

    Hashes seen lie in ``path/_seen`` and take no memory; a batch reads those files only that may hold its
    own, so its work doesn't grow with the stream. A replayed batch overwrites its folder and its hashes
    with the same rows.
    """

    def keep_new(batch: DataFrame, number: int) -> None:
        store = SeenHashes(batch.sparkSession, f"{path}/_seen")
        folder = f"{path}/batch={number}"
        exact.exact_dedup_with_store(batch, store, number, hash_type).write.mode("overwrite").parquet(folder)
        store.add(batch.sparkSession.read.schema("hash_id string").parquet(folder), number)

    return (
        stream.writeStream.foreachBatch(keep_new)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def annotate(stream: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Ingest filter, ingest quality and all scores, without state."""
    raw = to_raw(length_filter(stream))
    return quality.annotate(exact.with_hash(raw).withColumn("is_duplicate", F.lit(False)), cfg)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder until all files that are there now are done."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
