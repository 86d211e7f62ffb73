"""Shuffled orders by arithmetic: a keyed bijection of the numbers below ``n``.

A number is written as a pair (x, y) on a grid of ``a`` times ``b`` places, just over ``n`` of them. In each
round x moves by a hash of y, then y by a hash of x, which can be undone; after some rounds every number is
anywhere. What lands on one of the few places beyond ``n`` goes through the rounds again, which ends, as
the places form circles. So the place of any number and the number at any place are
expressions: nothing is sorted, exchanged or stored, whatever the number of epochs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamsift.config import SequenceConfig
from loamsift.functions.seeded import uniform
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import stage

ROUNDS = 6
# Circles have at most a places beyond n. Where a is larger than this, a place lies beyond n
# with a chance of less than 1 / WALKS each time; a walk that were longer is an error, never a wrong place.
WALKS = 64


def grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _moves(key: str, number: Column, side: str, of: Column, width: int) -> Column:
    return F.floor(uniform(key, number, F.lit(side), of) * width).cast("bigint")


def _once(place: Column, key: str, a: int, b: int, back: bool) -> Column:
    x, y = F.floor(place / b).cast("bigint"), place % b
    start = F.struct(x.alias("x"), y.alias("y"))

    def forth(now: Column, number: Column) -> Column:
        x = (now["x"] + _moves(key, number, "x", now["y"], a)) % a
        return F.struct(x.alias("x"), ((now["y"] + _moves(key, number, "y", x, b)) % b).alias("y"))

    def undo(now: Column, number: Column) -> Column:
        y = (now["y"] - _moves(key, number, "y", now["x"], b) + b) % b
        return F.struct(((now["x"] - _moves(key, number, "x", y, a) + a) % a).alias("x"), y.alias("y"))

    rounds = F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if back else range(ROUNDS))])
    return F.aggregate(rounds, start, undo if back else forth, lambda now: now["x"] * b + now["y"])


def permuted(number: Column, n: int, key: str, back: bool = False) -> Column:
    """Where ``number`` (a bigint from 0 to n - 1) stands in the order ``key``; with ``back``, the number at a place."""
    a, b = grid(n)
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), _once(number, key, a, b, back),
        lambda now, _: F.when(now < n, now).otherwise(_once(now, key, a, b, back)),
    )
    return F.when(again < n, again).otherwise(F.raise_error(F.lit("no place found")).cast("bigint"))


def numbered(ids: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, number): dense numbers in the order of ids, written once for all epochs; and how many."""
    table = stage(add_rank(ids.select("doc_id"), [F.col("doc_id")], "number"), "numbered")
    return table, table.count()


def epoch_order(table: DataFrame, n: int, epoch: int, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """(doc_id, batch_id, place) of every document in an epoch: a projection of the numbered ids."""
    at = table.select("doc_id", permuted(F.col("number"), n, f"{cfg.seed}:{epoch}").alias("_at"))
    return at.select("doc_id", F.floor(F.col("_at") / cfg.batch_size).alias("batch_id"), (F.col("_at") % cfg.batch_size).cast("int").alias("place"))


def epoch_batch(table: DataFrame, n: int, epoch: int, first: int, batches: int, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """(doc_id, batch_id, place) of ``batches`` batches from ``first`` on: only their own numbers are looked up."""
    spark: SparkSession = table.sparkSession
    size = cfg.batch_size
    places = spark.range(min(n, first * size), min(n, (first + batches) * size)).select(F.col("id").alias("_at"))
    wanted = places.select("_at", permuted(F.col("_at"), n, f"{cfg.seed}:{epoch}", back=True).alias("number"))
    found = table.join(wanted, "number")
    return found.select("doc_id", F.floor(F.col("_at") / size).alias("batch_id"), (F.col("_at") % size).cast("int").alias("place"))
