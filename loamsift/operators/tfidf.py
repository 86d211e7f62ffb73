"""Term weights in long form: one row per (document, term), never a dense matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from loamsift.config import SelectionConfig
from loamsift.functions.stopwords import ENGLISH
from loamsift.functions.text import word_ngrams
from loamsift.operators.staging import stage

# A term is a run of at least two letters, numbers or underscores.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
BROADCAST_MAX_TERMS = 200_000
PIECE_CHARS = 8_000_000  # of the texts that one task takes apart for the vocabulary


def kept_words(df: DataFrame, stop_words: tuple[str, ...] = ENGLISH, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep, _kept): words without stop words."""
    found = df.select("doc_id", *keep, F.regexp_extract_all(F.lower("text"), F.lit(TERM_PATTERN), 0).alias("_found"))
    return found.select("doc_id", *keep, F.filter("_found", lambda w: ~w.isin(*stop_words)).alias("_kept"))


def with_terms(df: DataFrame, stop_words: tuple[str, ...] = ENGLISH, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep, terms): words without stop words, then the pairs of neighbours left."""
    kept = kept_words(df, stop_words, keep)
    return kept.select("doc_id", *keep, F.concat("_kept", word_ngrams(F.col("_kept"), 2)).alias("terms"))


def _again(df: DataFrame, keep: tuple[str, ...]) -> DataFrame | None:
    """The (id, keep) of several rows, whose terms count together; None if there are none."""
    again = stage(df.groupBy("doc_id", *keep).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n"), "repeated_ids")
    return None if again.isEmpty() else again


def _matching(df: DataFrame, rows: DataFrame, names: tuple[str, ...], how: str) -> DataFrame:
    other = rows.select(*(F.col(name).alias(f"_{name}_") for name in names)).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}_")) for name in names]
    return df.join(other, same, how)


def _row_counts(df: DataFrame, stop_words: tuple[str, ...], keep: tuple[str, ...]) -> DataFrame:
    """(doc_id, keep, term, tf) of every row by itself: its sorted terms are counted in place, by where runs begin."""
    in_order = with_terms(df, stop_words, keep).select("doc_id", *keep, F.sort_array("terms").alias("_terms"))
    places = F.when(F.size("_terms") > 0, F.sequence(F.lit(0), F.size("_terms") - 1))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1)))
    ends = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(F.size("_terms")))
    runs = F.zip_with("_starts", ends, lambda a, b: F.struct(F.get("_terms", a).alias("term"), (b - a).cast("bigint").alias("tf")))
    counted = in_order.withColumn("_starts", starts).select("doc_id", *keep, runs.alias("_runs"))
    # The outer form keeps Catalyst from adding a "not empty" filter, which would work out all terms a second time.
    rows = counted.select("doc_id", *keep, F.explode_outer("_runs").alias("_run")).where(F.col("_run").isNotNull())
    return rows.select("doc_id", *keep, "_run.term", "_run.tf")


def term_counts(df: DataFrame, stop_words: tuple[str, ...] = ENGLISH, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep, term, tf) of all terms of all documents; stage it to read it more than once.

    Nothing is exchanged or held for it, but for rows that share their id.
    """
    again = _again(df, keep)
    if again is None:
        return _row_counts(df, stop_words, keep)
    key = ("doc_id", *keep)
    alone = _row_counts(_matching(df, again, key, "left_anti"), stop_words, keep)
    together = _row_counts(_matching(df, again, key, "left_semi"), stop_words, keep)
    return alone.unionByName(together.groupBy("doc_id", *keep, "term").agg(F.sum("tf").alias("tf")))


def _largest(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` terms with the largest (total, then first in order).

    A histogram by powers of two (at most 64 rows) finds a floor under the n-th total, so
    that the single merge of the limit sees about ``n`` rows and not ``n`` from every task.
    """
    power = F.floor(F.log2(F.col("total"))).cast("int")
    held, floor = 0, 0
    for row in sorted(counts.groupBy(power.alias("p")).count().collect(), key=lambda r: -r["p"]):
        held, floor = held + row["count"], row["p"]
        if held >= n:
            break
    return counts.where(power >= floor).orderBy(F.desc("total"), "term").limit(n)


def fit_vocabulary(
    target: DataFrame, cfg: SelectionConfig = SelectionConfig(), stop_words: tuple[str, ...] = ENGLISH
) -> tuple[DataFrame, int]:
    """((term, df, total, idf) of at most ``max_features`` terms, number of target documents)."""
    size = target.agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars")).first()
    # A task's table of terms is as large as its texts are, so these are dealt out by their length.
    pieces = max(target.sparkSession.sparkContext.defaultParallelism, (size["chars"] or 0) // PIECE_CHARS + 1)
    dealt = target.select("doc_id", "text").repartition(pieces, "doc_id")
    return vocabulary_of(term_counts(dealt, stop_words), size["docs"], cfg), size["docs"]


def vocabulary_of(per_doc: DataFrame, n_docs: int, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """``fit_vocabulary`` from the term counts of ``n_docs`` target documents."""
    counts = stage(
        per_doc.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        .where((F.col("df") >= cfg.min_df) & (F.col("df") <= F.lit(cfg.max_df * n_docs))),
        "term_counts",
    )
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    return stage(_largest(counts, cfg.max_features).withColumn("idf", idf), "vocabulary")


def _small(terms: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """A table of at most ``max_features`` rows: broadcast unless that was set very high."""
    return F.broadcast(terms) if cfg.max_features <= BROADCAST_MAX_TERMS else terms


def _words_coder(terms: list[str], idf: list[float], keep: tuple[str, ...]):
    """The function that a task applies to (doc_id, keep, words): rows of its vectors, document by document.

    Terms are words or pairs of them, so words are looked up once and pairs by the numbers of their words.
    It is made here so that it is sent whole: workers need not have this package.
    """
    known = sorted({word for term in terms for word in term.split(" ")})
    number = {word: i for i, word in enumerate(known)}
    size = len(known)
    # The code of a word is its number, that of a pair lies behind all of them.
    parts = [[number[word] for word in term.split(" ")] for term in terms]
    codes = np.array([p[0] if len(p) == 1 else size + p[0] * size + p[1] for p in parts], dtype=np.int64)
    order = np.argsort(codes)
    codes, weights = codes[order], np.array(idf, dtype=np.float64)[order]
    names = pa.array([terms[i] for i in order], pa.string())
    lookup = pa.array(known, pa.string())

    def rows_of(piece: pa.RecordBatch) -> pa.RecordBatch:
        words = piece.column("_kept")
        lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        word = pc.fill_null(pc.index_in(words.flatten(), value_set=lookup), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        both = (row[1:] == row[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
        found = np.concatenate([word[word >= 0], size + word[:-1][both] * size + word[1:][both]])
        of_row = np.concatenate([row[word >= 0], row[:-1][both]])
        at = np.searchsorted(codes, found)
        hit = at < len(codes)
        hit[hit] = codes[at[hit]] == found[hit]
        cell, tf = np.unique(of_row[hit] * len(codes) + at[hit], return_counts=True)
        doc, term = cell // len(codes), cell % len(codes)
        weight = tf * weights[term]
        norm = np.sqrt(np.bincount(doc, weight * weight, len(lengths)))
        columns = [piece.column(name).take(pa.array(doc)) for name in ("doc_id", *keep)]
        columns += [names.take(pa.array(term)), pa.array(tf, pa.int64()), pa.array(weight / norm[doc], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *keep, "term", "tf", "tfidf"])

    def coded(batches):
        for batch in batches:
            for start in range(0, batch.num_rows if len(codes) else 0, 1000):
                yield rows_of(batch.slice(start, 1000))

    return coded


def vectors(
    df: DataFrame,
    vocabulary: DataFrame,
    cfg: SelectionConfig = SelectionConfig(),
    stop_words: tuple[str, ...] = ENGLISH,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, keep, term, tf, tfidf), each document of length 1 over the terms it has.

    A row's vector is worked out in place. Only rows that share their id are brought together.
    """
    if cfg.max_features > BROADCAST_MAX_TERMS:
        return vectors_of(term_counts(df, stop_words, keep), vocabulary, cfg, keep)
    weights = vocabulary.select("term", "idf").collect()
    again = _again(df, ())
    alone = df if again is None else _matching(df, again, ("doc_id",), "left_anti")
    words = kept_words(alone, stop_words, keep)
    schema = StructType([words.schema[name] for name in ("doc_id", *keep)]).add("term", "string").add("tf", "long").add("tfidf", "double")
    coder = _words_coder([row["term"] for row in weights], [row["idf"] for row in weights], keep)
    rows = words.mapInArrow(coder, schema)
    if again is None:
        return rows
    together = term_counts(_matching(df, again, ("doc_id",), "left_semi"), stop_words, keep)
    return rows.unionByName(vectors_of(together, vocabulary, cfg, keep))


def vectors_of(
    per_doc: DataFrame, vocabulary: DataFrame, cfg: SelectionConfig = SelectionConfig(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """``vectors`` from term counts: each document's rows are brought together for its length."""
    return _unit_length(per_doc.join(_small(vocabulary.select("term", "idf"), cfg), "term"), keep)


def _unit_length(counted: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    weight = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("doc_id")))
    return counted.select("doc_id", *keep, "term", "tf", (weight / norm).alias("tfidf"))


def distribution(vecs: DataFrame, n_docs: int, smoothing: float = 0.0) -> DataFrame:
    """(term, p): mean vector over ``n_docs`` documents, scaled to sum to one."""
    means = vecs.groupBy("term").agg((F.sum("tfidf") / F.lit(float(n_docs))).alias("mean"))
    # One row per vocabulary term, so this window stays small.
    total = F.sum("mean").over(Window.partitionBy(F.lit(0)))
    return means.select("term", (F.col("mean") / (total + F.lit(smoothing))).alias("p"))


def importance(
    vocabulary: DataFrame, target: DataFrame, source: DataFrame, low: float = 0.1, high: float = 10.0
) -> DataFrame:
    """(term, weight): target over source probability, held within [low, high]."""
    p_target, p_source = F.coalesce("p_target", F.lit(0.0)), F.coalesce("p_source", F.lit(0.0))
    ratio = p_target / (p_source + F.lit(1e-10))
    return (
        vocabulary.select("term")
        .join(target.withColumnRenamed("p", "p_target"), "term", "left")
        .join(source.withColumnRenamed("p", "p_source"), "term", "left")
        .select("term", F.least(F.lit(high), F.greatest(F.lit(low), ratio)).alias("weight"))
    )


def document_scores(
    ids: DataFrame, vecs: DataFrame, weights: DataFrame, cfg: SelectionConfig = SelectionConfig(), digits: int = 6
) -> DataFrame:
    """(doc_id, dsir): weighted sum of each vector, 0 without a known term.

    Rounded, so that ranks do not hang on the order in which doubles were added.
    """
    summed = vecs.join(_small(weights, cfg), "term").groupBy("doc_id").agg(
        F.sum(F.col("tfidf") * F.col("weight")).alias("_sum")
    )
    score: Column = F.round(F.coalesce("_sum", F.lit(0.0)), digits)
    return ids.select("doc_id").join(summed, "doc_id", "left").select("doc_id", score.alias("dsir"))
