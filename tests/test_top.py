"""The best part without a sort, against sorting."""

import pytest
from pyspark.sql import functions as F

from loamsift.operators import top
from loamsift.operators.staging import stage


@pytest.mark.parametrize("limit", [50_000, 20])
@pytest.mark.parametrize("score", ["(id * 7919) % 1009 / 10", "id % 3", "0", "IF(id % 5 = 0, NULL, id % 100)", "IF(id < 2900, 1.5, id)"])
def test_same_as_sorting(spark, monkeypatch, limit, score):
    monkeypatch.setattr(top, "SORTED_ROWS", limit)
    df = stage(spark.range(3000).selectExpr("(id * 37) % 3000 AS doc_id", f"CAST({score} AS DOUBLE) AS s", "'x' AS text"), "rows")
    rows = sorted(df.collect(), key=lambda r: (r.s is None, -(r.s or 0), r.doc_id))
    for rate in (0.0, 0.001, 0.5, 0.95, 1.0):
        found = top.top_share(df, "s", rate)
        assert found.columns == df.columns
        assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in rows[: int(3000 * rate)])
    assert top.last_of_top(df, "s", 3001) is None and top.top_share(df.limit(0), "s", 0.5).count() == 0


def test_plan_has_no_exchange(spark):
    df = stage(spark.range(1000).select(F.col("id").alias("doc_id"), F.rand(3).alias("s")), "rows")
    plan = top.top_share(df, "s", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
