"""Mixing sources to target weights: rates from token counts, whole copies plus a Bernoulli one.

Words are summed up per source, the only shuffle of counts. A source's target is its share of the
budget by weight, at most ``max_rate`` times its words; what it cannot take is shared out again by
weight among the others, until none is above its limit. Each round of that is one sum over the
table of sources. A document is then emitted ``floor(rate)`` times, and once more if its number in
[0, 1), from the md5 of seed, id and text, is below the fraction of the rate.

Defined cases: a null text has no words. A null source is a source of its own, last in order. Documents
without words cost nothing and follow their source's rate. With no words at all every target is 0.
Repeated rows are documents of their own that share their draw. An empty table gives no rows.
Of other columns ``copy`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loamsift.functions.seeded import uniform
from loamsift.llm.common import boxed, small_side, text_of, word_count
from loamsift.operators.keyed_join import spread_join
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import stage

WEIGHTS = (3, 1, 2)  # by position of the source in code point order, repeating
BUDGET = 1.5
MAX_RATE = 2.0
SEED = "mix"


def _keyed(df: DataFrame) -> DataFrame:
    """A key for the source that is never null: "z" for null, which sorts last, "s" and the name otherwise."""
    return df.withColumn("_source", F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), F.col("source"))))


def sized_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Narrow rows: ``doc_id, _source, size`` in words, and the document's draw in [0, 1)."""
    return _keyed(docs.select("doc_id", "source", "text")).select(
        "doc_id", "_source", word_count(text_of()).alias("size"),
        uniform(seed, F.col("doc_id"), F.md5(text_of())).alias("_draw"),
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_rate: float = MAX_RATE
) -> DataFrame:
    """A row per source: ``_source, _rows, source_size, target, rate``."""
    totals = sizes.groupBy("_source").agg(F.count("*").alias("_rows"), F.sum("size").alias("source_size"))
    ranked = add_rank(stage(totals, "op2_sources"), [F.col("_source")], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    sources = stage(
        ranked.select("_source", "_rows", "source_size", weight.alias("_weight"), (F.col("source_size") * F.lit(max_rate)).alias("_most")),
        "op2_weighted",
    )
    whole = budget * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        # Sources that the present level would lift above their limit are full; the rest share what is left.
        is_full = F.col("_weight") * F.lit(level) > F.col("_most")
        sums = sources.agg(
            F.count_if(is_full).alias("full"),
            F.sum(F.when(is_full, F.col("_most")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if sums["full"] == full or not sums["weight"]:
            break
        full, level = sums["full"], (whole - sums["taken"]) / sums["weight"]
    target = F.when(F.col("_weight") * F.lit(level) > F.col("_most"), F.col("_most")).otherwise(F.col("_weight") * F.lit(level))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return sources.select("_source", "_rows", "source_size", target.alias("target")).withColumn("rate", rate)


def with_targets(rows: DataFrame, targets: DataFrame, spread_by: str = "doc_id") -> DataFrame:
    """Attach each row's source columns: broadcast if the sources are few, else with hot sources split."""
    small = small_side(targets)
    if small is not targets:
        return rows.join(small.drop("_rows"), "_source")
    return spread_join(rows, targets.drop("_rows"), "_source", spread_by, counts=targets.select("_source", "_rows"))


def copies(draw: str = "_draw"):
    whole = F.floor("rate")
    return (whole + (F.col(draw) < F.col("rate") - whole).cast("bigint")).cast("bigint")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, numbered by ``copy`` from 0."""
    seed = options.pop("seed", SEED)
    targets = stage(source_targets(sized_documents(docs, seed), **options), "op2_targets")
    rows = boxed(docs.drop("copy"), "source", "doc_id", uniform(seed, F.col("doc_id"), F.md5(text_of())).alias("_draw"))
    taken = with_targets(_keyed(rows), targets).withColumn("_copies", copies()).where("_copies > 0")
    return taken.select("_row.*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)).alias("copy"))
