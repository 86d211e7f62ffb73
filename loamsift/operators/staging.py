"""Written tables that cut lineage between steps.

A staged table lives in the shared folder that ``spark.checkpoint.dir`` names, so a
lost executor costs a re-read and not a recompute, and the planner sees the true size
of the table, which is what decides whether a join is broadcast. Only a local session
with the setting unset falls back to a temporary folder. The files stay until the
cluster's own retention of that folder removes them, as lazily read results need them;
within ``staged_run``, where all results are written elsewhere, they go at its end.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_run = ""


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="loamsift-")
    return _local_root


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/loamsift/{app}/{_run}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; read nothing of them later."""
    global _run
    before = _run
    folder = new_path(spark, "run")
    _run = f"{before}{folder.rpartition('/')[2]}/"
    try:
        yield
    finally:
        _run = before
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
