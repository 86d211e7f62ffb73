"""The best part of a table without sorting it.

Where ranks aren't asked for, all that is needed is the last row that still belongs to the best ones. Two
quantiles of a mergeable sketch enclose it; exact counts say how many rows lie above and between them, and
the search goes on between them until few rows are left, which alone are sorted. Many rows of one score are
told apart by their keys in the same way. A row's membership is then a comparison, so nothing is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.operators.staging import stage

SORTED_ROWS = 50_000
ACCURACY = 2_000  # of the sketch: an error of at most one in so many rows


def _narrowed(rows: DataFrame, m: int, place: int, column: Column) -> tuple[DataFrame, int, int, bool]:
    """Rows around the ``place``-th (from 1) of ``m`` by ``column`` from small to large; how many; the place among them; and
    whether they have one value.

    Ends with at most ``SORTED_ROWS`` rows, with rows of one value, or where the sketch tells no more.
    """
    while m > SORTED_ROWS:
        share, margin = place / m, 2 / ACCURACY
        low, high = rows.agg(F.percentile_approx(column, [max(0.0, share - margin), min(1.0, share + margin)], ACCURACY)).first()[0]
        below, between = rows.agg(F.count_if(column < low), F.count_if(column.between(low, high))).first()
        if not below < place <= below + between or between == m and low < high:
            break
        rows, m, place = rows.where(column.between(low, high)), between, place - below
        if low == high:
            return rows, m, place, True
    return rows, m, place, False


def last_of_top(rows: DataFrame, score: str, keep: int, key: str = "doc_id") -> tuple[float, int] | None:
    """Score and key of the ``keep``-th row by (score desc, key); a null score comes last. None if there are fewer rows."""
    value = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    narrow = stage(rows.select(value.alias("_score"), F.col(key).alias("_key")), "top_scores")
    n = narrow.count()
    if not 0 < keep <= n:
        return None
    around, m, place, tied = _narrowed(narrow, n, keep, -F.col("_score"))
    if tied:
        around, m, place, _ = _narrowed(around, m, place, F.col("_key"))
    first = around.orderBy(F.col("_score").desc(), F.col("_key")).limit(place)
    last = first.orderBy(F.col("_score"), F.col("_key").desc()).first()
    return last["_score"], last["_key"]


def top_share(df: DataFrame, score: str, rate: float, key: str = "doc_id") -> DataFrame:
    """The ``floor(n * rate)`` best rows by (score desc, key), all columns, in no order. ``key`` is unique."""
    keep = int(df.count() * rate)
    last = last_of_top(df.select(score, key), score, keep, key)
    if last is None:
        return df.limit(0)
    value = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    return df.where((value > last[0]) | ((value == last[0]) & (F.col(key) <= last[1])))
