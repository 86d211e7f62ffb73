"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Every query starts from the given tables and runs to its last row; nothing is kept between them.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from loamsift.plans.queries import QUERIES

HEADLINE = (
    "exact_dedup",
    "annotate_quality",
    "fuzzy_matches",
    "process_dataset",
    "dsir_scores",
    "hybrid_select",
    "unimax_batch",
    "alpha_batch",
    "training_sequences",
    "epoch_batches",
)


def main() -> None:
    # Python workers import the library from here, wherever the benchmark is started.
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH"))))
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loamsift-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loamsift-shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
        "documents": documents,
        "documents_per_second": {name: round(documents / s, 1) for name, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
