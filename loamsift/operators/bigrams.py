"""A trained bigram model and the perplexity of documents under it.

Kneser-Ney smoothing, interpolated: a seen pair keeps its count less a discount, and what the
discounts of a context free goes to all words by the number of different words they follow
(a word that follows only one other is a poor guess after a new one). That second distribution is
discounted the same way in favour of words never seen. All probabilities of a context add up to one.

Words are looked up by 64-bit hashes. Pairs are counted in one pass, for the model and for the documents
to score. The probability of every distinct pair of the scored documents is worked out once; the corpus
itself is joined once, as (doc_id, pair) rows, and never written. What is known of frequent words is broadcast
(at most ``FREQUENT`` of them), so that only pairs with a rare word move for it. Frequent pairs, contexts and words are
split over tasks by their counts.

Defined cases: a null or empty text is just its end. Repeated rows of a ``doc_id`` are scored as one
document. A model of no documents gives every word the probability one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.functions.text import words
from loamsift.operators.keyed_join import spread_join
from loamsift.operators.staging import stage

DISCOUNT = 0.75
FREQUENT = 200_000
BEGIN, END = " <", " >"  # no word has a space


def word_pairs(df: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, keep, before, word): hashes of every word and of the one before it, with begin and end."""
    tokens = words(F.lower(F.coalesce("text", F.lit(""))))
    hashed = F.transform(F.concat(F.array(F.lit(BEGIN)), tokens, F.array(F.lit(END))), lambda word: F.xxhash64(word))
    rows = df.select("doc_id", *keep, hashed.alias("_words"))
    before = F.slice("_words", F.lit(1), F.size("_words") - 1)
    after = F.slice("_words", F.lit(2), F.size("_words") - 1)
    # The outer form keeps Catalyst from adding a "not empty" filter, which would take all texts apart a second time.
    pairs = rows.select("doc_id", *keep, F.explode_outer(F.arrays_zip(before.alias("before"), after.alias("word"))).alias("_pair"))
    return pairs.select("doc_id", *keep, F.col("_pair.before").alias("before"), F.col("_pair.word").alias("word"))


def pair_counts(df: DataFrame, target: Column | None = None) -> DataFrame:
    """(before, word, _rows, n): how often every pair stands in ``df`` and how often in its ``target`` rows, counted in one pass."""
    rows = word_pairs(df.withColumn("_target", F.lit(True) if target is None else F.coalesce(target, F.lit(False))), "_target")
    return stage(rows.groupBy("before", "word").agg(F.count("*").alias("_rows"), F.count_if("_target").alias("n")), "bigram_counts")


@dataclass(frozen=True)
class BigramModel:
    """(before, word, seen), and the written tables that it comes from: (before, word, n), (before, total, back_off)
    and (word, chance); ``unknown`` is the chance of an unknown word."""

    pairs: DataFrame
    contexts: DataFrame
    words: DataFrame
    unknown: float
    counts: DataFrame
    discount: float


def fit(df: DataFrame, discount: float = DISCOUNT) -> BigramModel:
    """The model of the documents in ``df``."""
    return fit_counts(pair_counts(df), discount)


def fit_counts(counts: DataFrame, discount: float = DISCOUNT) -> BigramModel:
    """The model of the target rows of ``pair_counts``."""
    counted = counts.where(F.col("n") > 0).select("before", "word", "n")
    contexts = stage(counted.groupBy("before").agg(F.sum("n").alias("total"), F.count("*").alias("_rows")), "bigram_contexts")
    follows = stage(counted.groupBy("word").agg(F.count("*").alias("_rows")), "bigram_words")
    sizes = follows.agg(F.count("*").alias("words"), F.sum("_rows").alias("pairs")).first()
    spare = discount * sizes["words"] / sizes["pairs"] if sizes["pairs"] else 1.0
    unknown = spare / (sizes["words"] + 1)
    of_context = contexts.select("before", "total")
    pairs = spread_join(counted, of_context, "before", "word", counts=contexts.select("before", "_rows"))
    return BigramModel(
        pairs.select("before", "word", ((F.col("n") - discount) / F.col("total")).alias("seen")),
        contexts.select("before", "total", (F.lit(discount) * F.col("_rows") / F.col("total")).alias("back_off")),
        follows.select("word", ((F.col("_rows") - discount) / F.lit(sizes["pairs"] or 1) + F.lit(unknown)).alias("chance")),
        unknown,
        counted,
        discount,
    )


def probability(model: BigramModel) -> Column:
    """P(word | before) from the count of the pair and the joined columns of the tables of contexts and words."""
    chance = F.coalesce("chance", F.lit(model.unknown))
    seen = F.when(F.col("n") > 0, (F.col("n") - model.discount) / F.col("total")).otherwise(F.lit(0.0))
    return seen + F.coalesce("back_off", F.lit(1.0)) * chance


def pair_probabilities(pairs: DataFrame, model: BigramModel) -> DataFrame:
    """``pairs`` (distinct ``before, word``) with ``known`` and ``p``."""
    return _priced(pairs.join(model.counts, ["before", "word"], "left"), pairs.columns, model)


def _frequent(counts: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """The rows of ``table`` for the keys that hold over 1 / ``FREQUENT`` of all rows: fewer than ``FREQUENT``."""
    bound = (counts.agg(F.sum("_rows")).first()[0] or 0) // FREQUENT
    return F.broadcast(counts.where(F.col("_rows") > bound).select(key, F.lit(True).alias(f"_{key}")).join(table, key, "left"))


def _priced(counted: DataFrame, keep: list[str], model: BigramModel) -> DataFrame:
    """``counted`` (distinct ``before, word`` with ``n``): pairs of frequent words stay in place, the others are moved."""
    of_before = stage(counted.groupBy("before").agg(F.count("*").alias("_rows")), "scored_contexts")
    of_word = stage(counted.groupBy("word").agg(F.count("*").alias("_rows")), "scored_words")
    met = counted.join(_frequent(of_before, "before", model.contexts), "before", "left")
    met = met.join(_frequent(of_word, "word", model.words), "word", "left")
    both = F.col("_before").isNotNull() & F.col("_word").isNotNull()
    rest = met.where(~both).select(*counted.columns)
    rest = spread_join(rest, model.contexts, "before", "word", "left", counts=of_before)
    rest = spread_join(rest, model.words, "word", "before", "left", counts=of_word)
    found = [F.coalesce(F.col("n") > 0, F.lit(False)).alias("known"), probability(model).alias("p")]
    return met.where(both).select(*keep, *found).unionByName(rest.select(*keep, *found))


def _scored_counts(df: DataFrame, model: BigramModel) -> DataFrame:
    """(before, word, _rows, n) of the pairs in ``df``; ``n`` is the model's."""
    own = word_pairs(df).select("before", "word", F.lit(1).cast("bigint").alias("_rows"), F.lit(0).cast("bigint").alias("n"))
    known = model.counts.select("before", "word", F.lit(0).cast("bigint").alias("_rows"), "n")
    both = own.unionByName(known).groupBy("before", "word").agg(F.sum("_rows").alias("_rows"), F.sum("n").alias("n"))
    return stage(both.where(F.col("_rows") > 0), "scored_counts")


def perplexity(df: DataFrame, model: BigramModel, counts: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, log10_perplexity): tokens are words and the end, known ones stand in a seen pair.

    ``counts`` are the ``pair_counts`` of the same ``df``, if the model was fitted on them. The words are made from the
    texts again for the join, so that no table of them is written.
    """
    counts = _scored_counts(df, model) if counts is None else counts
    pair = F.xxhash64("before", "word").alias("pair")
    priced = _priced(counts, ["before", "word"], model).select(pair, "known", F.log10("p").alias("log10_p"))
    # Partial sums are made in the tasks of the join, so a document's rows don't meet one by one.
    found = spread_join(word_pairs(df).select("doc_id", pair), priced, "pair", "doc_id", counts=counts.select(pair, "_rows"))
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"), F.count_if("known").alias("n_known"), (-F.sum("log10_p") / F.count("*")).alias("log10_perplexity")
    )


def perplexity_filter(df: DataFrame, scores: DataFrame, limit: float) -> DataFrame:
    """The rows of ``df`` whose document has a perplexity of at most ``limit``."""
    good = scores.where(F.col("log10_perplexity") <= F.log10(F.lit(float(limit)))).select("doc_id")
    return df.join(good, "doc_id", "left_semi")
