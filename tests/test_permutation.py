"""Orders by arithmetic: every number once, both ways, without an exchange."""

import pytest
from pyspark.sql import functions as F

from loamsift.config import SequenceConfig
from loamsift.operators import permutation


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 17, 64, 65, 1000, 4099])
def test_every_number_has_one_place_and_back(spark, n):
    rows = spark.range(n).select(
        "id", permutation.permuted(F.col("id"), n, "k").alias("at"), permutation.permuted(F.col("id"), n, "other").alias("at_other")
    )
    rows = rows.withColumn("back", permutation.permuted(F.col("at"), n, "k", back=True)).collect()
    assert sorted(r["at"] for r in rows) == sorted(r["at_other"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)
    if n >= 64:
        assert sum(r["at"] == r["id"] for r in rows) < 8 and sum(r["at"] == r["at_other"] for r in rows) < 8
        # Neighbours don't stay neighbours.
        at = [r["at"] for r in sorted(rows, key=lambda r: r["id"])]
        assert sum(abs(x - y) == 1 for x, y in zip(at, at[1:])) < 10


def test_grid_holds_every_number():
    for n in [*range(1, 3000), 10**6 + 7, 10**11 + 3]:
        a, b = permutation.grid(n)
        assert a * b >= n > a * b - a - 1 and (a - 1) ** 2 < n


def test_epochs_and_batches(spark):
    ids = spark.range(0, 300, 3).withColumnRenamed("id", "doc_id")
    table, n = permutation.numbered(ids)
    cfg = SequenceConfig(batch_size=8)
    orders = []
    for epoch in (0, 1):
        order = permutation.epoch_order(table, n, epoch, cfg)
        assert "Exchange" not in order._jdf.queryExecution().executedPlan().toString()
        rows = {(r["batch_id"], r["place"]): r["doc_id"] for r in order.collect()}
        assert sorted(rows) == [(i // 8, i % 8) for i in range(100)] and sorted(rows.values()) == list(range(0, 300, 3))
        some = permutation.epoch_batch(table, n, epoch, 11, 5, cfg).collect()  # the last one is short, one doesn't exist
        assert {(r["batch_id"], r["place"]): r["doc_id"] for r in some} == {k: v for k, v in rows.items() if k[0] >= 11}
        orders.append(rows)
    assert orders[0] != orders[1]


def test_no_documents(spark):
    table, n = permutation.numbered(spark.range(0).withColumnRenamed("id", "doc_id"))
    assert n == 0 and permutation.epoch_order(table, n, 0).count() == 0 and permutation.epoch_batch(table, n, 0, 0, 3).count() == 0
