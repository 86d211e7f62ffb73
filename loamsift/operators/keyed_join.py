"""An equi-join that stays balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_HOT_KEYS = 50_000
MIN_ROWS_PER_TASK = 200_000


def hot_limit(counts: DataFrame, min_rows: int | None = None) -> int | None:
    """The rows above which a key of ``counts`` (key, ``_rows``) is hot; None if no key is."""
    top = counts.agg(F.sum("_rows").alias("rows"), F.max("_rows").alias("most")).first()
    limit = max(min_rows or MIN_ROWS_PER_TASK, (top["rows"] or 0) // MAX_HOT_KEYS)
    return limit if (top["most"] or 0) > limit else None


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Join ``many`` (rows repeat per key) to ``one`` (one or few per key), splitting hot keys.

    A key is hot above ``max(min_rows, rows / MAX_HOT_KEYS)`` rows, so there can be at most
    ``MAX_HOT_KEYS`` of them: the list is bounded and is broadcast. A hot key's rows are
    spread over one salt per such amount by ``spread_by``, and only its rows of ``one`` are
    copied, once per salt, which adds at most ``MAX_HOT_KEYS`` copies over all keys together.

    ``counts`` (``key``, ``_rows``) saves counting ``many`` if it is known.
    """
    if counts is None:
        counts = many.groupBy(key).agg(F.count("*").alias("_rows"))
    limit = hot_limit(counts, min_rows)
    if limit is None:
        return many.join(one, key, how)
    salts = F.broadcast(
        counts.where(F.col("_rows") > limit).select(key, F.ceil(F.col("_rows") / limit).alias("_salts"))
    )
    one_salt = F.coalesce(F.col("_salts"), F.lit(1))
    left = many.join(salts, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), one_salt)
    ).drop("_salts")
    right = one.join(salts, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), one_salt.cast("bigint") - 1))
    ).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
