"""Hashes seen in earlier batches, as a written table of which a new batch reads next to nothing.

Every batch adds its hashes in files by bucket, and for each bucket a Bloom filter of ``BITS`` bits a
hash (about two in a billion others pass it). A later batch first asks the filters of its buckets; only
files whose filter holds one of its hashes are read, to be certain. A batch of new texts thus reads
filters alone, whatever came before, and a copy costs one file.

A batch that is done again overwrites its own files and looks at earlier batches only, so a job that
was cut off can be repeated. Nothing is kept in memory or on the driver but the names of files to read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamsift.operators.staging import stage

BUCKETS = 256
BITS, PROBES = 48, 16
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))  # fixed values: odd factors that spread bits
MAX_FILES = 20_000  # of single files to read; beyond, whole batches are


def _tasks() -> tuple[Callable[[pa.Table], pa.Table], Callable[[pa.Table, pa.Table], pa.Table]]:
    """The functions that tasks apply: the filter of a bucket's hashes, and the hashes that filters let pass.

    They are made here so that they are sent whole: workers need not have this package.
    """
    nothing = pa.table({"hash_id": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()), "batch": pa.array([], pa.int64())})

    def places(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
        """The bits of each hash, a row each, in a filter of ``size`` bits (a power of two)."""
        steps = np.arange(PROBES, dtype=np.uint64)
        rows = first.view(np.uint64)[:, None] + steps * (second.view(np.uint64) | np.uint64(1))[:, None]
        for factor in _MIX:  # else small filters would see few different series of places
            rows = (rows ^ (rows >> np.uint64(33))) * factor
        return ((rows ^ (rows >> np.uint64(33))) & np.uint64(size - 1)).astype(np.int64)

    def filter_of(rows: pa.Table) -> pa.Table:
        size = 1 << max(9, (BITS * rows.num_rows - 1).bit_length())
        bits = np.zeros(size, bool)
        bits[places(rows.column("first").to_numpy(), rows.column("second").to_numpy(), size)] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"bucket": pa.array([rows.column("bucket")[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    def maybe(rows: pa.Table, filters: pa.Table) -> pa.Table:
        """(hash_id, bucket, batch) of the hashes that a batch's filter lets pass."""
        found = []
        if rows.num_rows:
            first, second = rows.column("first").to_numpy(), rows.column("second").to_numpy()
            for batch, raw in zip(filters.column("batch").to_pylist(), filters.column("bits")):
                bits = np.frombuffer(raw.as_buffer(), np.uint8)
                at = places(first, second, 8 * len(bits))
                held = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)
                found.append(rows.filter(pa.array(held)).select(["hash_id", "bucket"]).append_column("batch", pa.array(np.full(held.sum(), batch, np.int64))))
        return pa.concat_tables(found) if found else nothing

    return filter_of, maybe


@dataclass(frozen=True)
class SeenHashes:
    """The store under ``path``, a folder that all executors reach."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def _keyed(self, hashes: DataFrame) -> DataFrame:
        own = F.xxhash64("hash_id")
        return hashes.select(
            "hash_id", F.pmod(own, F.lit(self.buckets)).cast("int").alias("bucket"),
            F.xxhash64(F.lit(1), "hash_id").alias("first"), F.xxhash64(F.lit(2), "hash_id").alias("second"),
        )

    def add(self, hashes: DataFrame, batch: int) -> None:
        """Write the distinct ``hash_id`` of a batch. What it wrote before is replaced."""
        files = f"{self.path}/hashes/batch={batch}"
        rows = hashes.select("hash_id").withColumn("bucket", F.pmod(F.xxhash64("hash_id"), F.lit(self.buckets)).cast("int"))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(files)
        written = self.spark.read.schema("hash_id string, bucket int").parquet(files)
        filters = self._keyed(written.select("hash_id")).groupBy("bucket").applyInArrow(_tasks()[0], "bucket int, bits binary")
        filters.write.mode("overwrite").parquet(f"{self.path}/filters/batch={batch}")

    def _filters(self, batch: int) -> DataFrame | None:
        try:
            filters = self.spark.read.schema("bucket int, bits binary, batch bigint").parquet(f"{self.path}/filters")
        except AnalysisException:  # nothing was ever added
            return None
        return filters.where(F.col("batch") < batch)

    def maybe(self, hashes: DataFrame, batch: int) -> DataFrame:
        """(hash_id, bucket, batch): which batches before ``batch`` may hold which of the distinct ``hashes``."""
        filters = self._filters(batch)
        if filters is None:
            return self.spark.createDataFrame([], "hash_id string, bucket int, batch bigint")
        rows = self._keyed(hashes)
        return rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_tasks()[1], "hash_id string, bucket int, batch bigint")

    def seen(self, hashes: DataFrame, batch: int) -> DataFrame:
        """(hash_id): those of the distinct ``hashes`` that a batch before ``batch`` has added."""
        maybe = stage(self.maybe(hashes, batch), "maybe_seen")
        places = maybe.select("batch", "bucket").distinct()
        files = [f"{self.path}/hashes/batch={r['batch']}/bucket={r['bucket']}" for r in places.limit(MAX_FILES + 1).collect()]
        if not files:
            return maybe.select("hash_id")
        if len(files) > MAX_FILES:
            batches = [r["batch"] for r in places.select("batch").distinct().collect()]
            files = [f"{self.path}/hashes/batch={number}" for number in batches]
        held = self.spark.read.schema("hash_id string").option("basePath", f"{self.path}/hashes").parquet(*files).select("hash_id")
        return maybe.select("hash_id").distinct().join(held, "hash_id", "left_semi")
