"""Split, encoding and batching of the documents into sequence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.config import SequenceConfig
from loamsift.functions import text as tx
from loamsift.functions.seeded import uniform
from loamsift.operators.ranking import add_rank

# Codes of the character encoding.
PAD, BEGIN, END, SPACE_CODE, OTHER_CODE = 0, 1, 2, 50, 51
CODE_OFFSET, CODE_RANGE = 100, 31_900


def with_split(selected: DataFrame, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """Every row with ``split``: the first ``floor(n * train_share)`` in selection order are for training.

    The selection rank is dense already, so nothing is sorted or joined; without one, order is by id.
    """
    if "selection_rank" not in selected.columns:
        ranked = add_rank(selected.select("doc_id"), [F.col("doc_id")])
        return selected.join(_split(ranked, F.col("rank"), selected.count(), cfg).drop("rank"), "doc_id")
    return _split(selected, F.col("selection_rank"), selected.count(), cfg)


def _split(rows: DataFrame, rank: Column, n: int, cfg: SequenceConfig) -> DataFrame:
    return rows.withColumn("split", F.when(rank < int(n * cfg.train_share), "train").otherwise("eval"))


def train_eval_split(selected: DataFrame, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """(doc_id, split)."""
    return with_split(selected, cfg).select("doc_id", "split")


def encode(text: Column) -> Column:
    """Codes of the lowercased characters between a begin and an end mark.

    Whitespace and other signs are first replaced by one stand-in each over the whole text,
    which leaves a single cheap test per character.
    """
    space, other = "\x01", "\x02"
    plain = F.regexp_replace(
        F.lower(text), f"{tx.UNICODE}[^{tx.ALPHANUMERIC}{tx.WHITESPACE}]", other
    )
    plain = F.regexp_replace(plain, f"{tx.UNICODE}[{tx.WHITESPACE}]", space)
    codes = F.transform(
        F.array_remove(F.split(plain, ""), ""),
        lambda c: F.when(c == space, SPACE_CODE)
        .when(c == other, OTHER_CODE)
        .otherwise(F.ascii(c) % CODE_RANGE + CODE_OFFSET),
    )
    return F.concat(F.array(F.lit(BEGIN)), codes, F.array(F.lit(END)))


def token_count(text: Column) -> Column:
    return F.length(F.lower(text)) + 2


def encode_documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", encode(F.col("text")).alias("tokens"))


def fit_length(tokens: Column, length: int) -> Column:
    """Cut to ``length`` or filled up with padding."""
    missing = F.greatest(F.lit(length) - F.size(tokens), F.lit(0))
    return F.concat(F.slice(tokens, 1, length), F.array_repeat(F.lit(PAD), missing))


def padded(df: DataFrame, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    return encode_documents(df).select("doc_id", fit_length(F.col("tokens"), cfg.max_length).alias("tokens"))


def training_sequences(
    df: DataFrame, cfg: SequenceConfig = SequenceConfig(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, input_ids, labels, attention_mask, n_tokens) and ``keep``: labels are the inputs moved by one.

    Only the characters that fit are encoded; a text that is cut loses its end mark.
    """
    n = cfg.max_length - 1
    cut = F.substring(F.lower("text"), 1, n)
    coded = df.select("doc_id", *keep, token_count(F.col("text")).alias("n_tokens"), encode(cut).alias("_coded")).select(
        "doc_id", *keep, "n_tokens", fit_length(F.col("_coded"), cfg.max_length).alias("_tokens")
    )
    return coded.select(
        "doc_id",
        F.slice("_tokens", 1, n).alias("input_ids"),
        F.slice("_tokens", 2, n).alias("labels"),
        F.array_repeat(F.lit(True), n).alias("attention_mask"),
        "n_tokens",
        *keep,
    )


def epoch_batches(
    ids: DataFrame, epoch: int = 0, cfg: SequenceConfig = SequenceConfig(), shuffle: bool = True, order: str = "doc_id"
) -> DataFrame:
    """(doc_id, batch_id, place): batches of an epoch in a seeded order, or in the given one."""
    if shuffle:
        mixed = ids.select("doc_id", uniform(cfg.seed, F.lit(epoch), F.col("doc_id")).alias("_u"))
        ranked = add_rank(mixed, [F.col("_u"), F.col("doc_id")])
    else:
        ranked = add_rank(ids.select("doc_id", F.col(order).alias("_o")), [F.col("_o"), F.col("doc_id")])
    size = F.lit(cfg.batch_size)
    return ranked.select(
        "doc_id",
        F.floor(F.col("rank") / size).alias("batch_id"),
        (F.col("rank") % size).cast("int").alias("place"),
    )


def token_totals(df: DataFrame, splits: DataFrame) -> DataFrame:
    """(split, domain, documents, tokens)."""
    sized = df.select("doc_id", "domain", token_count(F.col("text")).alias("n"))
    return sized.join(splits, "doc_id").groupBy("split", "domain").agg(
        F.count("*").alias("documents"), F.sum("n").alias("tokens")
    )
