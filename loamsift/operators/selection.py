"""Selecting the documents that look most like a target set and score best by attributes.

Scores and ranks are worked out on (doc_id, score) alone; the text is joined back at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.config import SelectionConfig
from loamsift.functions.lookup import weight_of
from loamsift.operators import tfidf
from loamsift.operators.ranking import top_fraction
from loamsift.operators.staging import stage
from loamsift.operators.top import top_share

_TINY = 1e-10


def target_flag(processed: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> Column:
    """Whether a row is of the target class, or of the medium class too if those are too few."""
    of_class = F.coalesce(F.col("quality_class") == cfg.target_class, F.lit(False))
    if processed.where(of_class).limit(cfg.full_target_docs).count() >= cfg.full_target_docs:
        return of_class
    return of_class | F.coalesce(F.col("quality_class") == "medium", F.lit(False))


def target_docs(processed: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """(doc_id, text) of the target set."""
    targets = processed.where(target_flag(processed, cfg)).select("doc_id", "text")
    if cfg.target_class == "medium" and targets.limit(cfg.full_target_docs).count() < cfg.full_target_docs:
        # Listed twice: a copy is a document of its own.
        return targets.unionByName(targets.withColumn("doc_id", -F.col("doc_id") - 1))
    return targets


def enough_targets(target: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> bool:
    return target.limit(cfg.min_target_docs).count() >= cfg.min_target_docs


@dataclass(frozen=True)
class Importance:
    """What fitting on a target set leaves: small tables, at most one row per term."""

    vocabulary: DataFrame
    target: DataFrame
    cfg: SelectionConfig


def fit_importance(target: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> Importance:
    vocabulary, n_docs = tfidf.fit_vocabulary(target, cfg)
    vecs = tfidf.vectors(target, vocabulary, cfg)
    return Importance(vocabulary, stage(tfidf.distribution(vecs, n_docs), "target_distribution"), cfg)


def fit_within(docs: DataFrame, is_target: Column, cfg: SelectionConfig = SelectionConfig()) -> tuple[Importance, DataFrame]:
    """``fit_importance`` for a target that is part of ``docs``, and the vectors of all ``docs``."""
    flagged = docs.select("doc_id", "text", is_target.alias("_target"))
    vocabulary, n_docs = tfidf.fit_vocabulary(flagged.where("_target").select("doc_id", "text"), cfg)
    vecs = stage(tfidf.vectors(flagged, vocabulary, cfg, keep=("_target",)), "doc_terms")
    target = stage(tfidf.distribution(vecs.where("_target"), n_docs), "target_distribution")
    return Importance(vocabulary, target, cfg), vecs.drop("_target")


def importance_scores(docs: DataFrame, fitted: Importance, vecs: DataFrame | None = None) -> DataFrame:
    """(doc_id, dsir) of every document of one source."""
    cfg = fitted.cfg
    if vecs is None:  # read twice: for the source distribution, then for the scores
        vecs = stage(tfidf.vectors(docs, fitted.vocabulary, cfg), "doc_terms")
    source = tfidf.distribution(vecs, max(docs.count(), 1), _TINY)
    weights = stage(tfidf.importance(fitted.vocabulary, fitted.target, source), "importance")
    return tfidf.document_scores(docs, vecs, weights, cfg)


def _with_rows(docs: DataFrame, ranked: DataFrame, selected_by: str) -> DataFrame:
    return docs.join(ranked, "doc_id").withColumn("selected_by", F.lit(selected_by))


def dsir_select(
    docs: DataFrame, fitted: Importance, vecs: DataFrame | None = None, rate: float | None = None
) -> DataFrame:
    rate = fitted.cfg.rate if rate is None else rate
    scores = stage(
        importance_scores(docs, fitted, vecs).withColumnRenamed("dsir", "selection_score"), "dsir_scores"
    )
    return _with_rows(docs, top_fraction(scores, "selection_score", rate), "dsir")


def attribute_score(
    quality: Column, domain: Column, cfg: SelectionConfig = SelectionConfig(), include_scores: bool = False
) -> Column:
    """Weight of the class plus weight of the domain; with ``include_scores`` also the
    ``quality_score`` and ``1 - toxicity_score`` columns."""
    score = weight_of(F.coalesce(quality, F.lit("medium")), cfg.quality_weights, cfg.other_weight) + weight_of(
        F.coalesce(domain, F.lit("unknown")), cfg.domain_weights, cfg.other_weight
    )
    if include_scores:
        score = score + F.col("quality_score") + (F.lit(1.0) - F.col("toxicity_score"))
    return score


def attribute_select(docs: DataFrame, cfg: SelectionConfig = SelectionConfig(), include_scores: bool = False) -> DataFrame:
    score = attribute_score(F.col("quality_class"), F.col("domain"), cfg, include_scores)
    scores = stage(docs.select("doc_id", score.alias("selection_score")), "attribute_scores")
    return _with_rows(docs, top_fraction(scores, "selection_score", cfg.rate), "attribute")


def attribute_share(docs: DataFrame, cfg: SelectionConfig = SelectionConfig(), include_scores: bool = False) -> DataFrame:
    """The rows that ``attribute_select`` takes, without ranks: nothing is sorted or exchanged for them."""
    score = attribute_score(F.col("quality_class"), F.col("domain"), cfg, include_scores)
    return top_share(docs.withColumn("selection_score", score), "selection_score", cfg.rate)


def _unit_range(column: str, low: float, high: float) -> Column:
    return (F.col(column) - F.lit(low)) / F.lit(high - low + _TINY)


def hybrid_scores(
    docs: DataFrame, fitted: Importance, vecs: DataFrame | None = None, digits: int = 6
) -> DataFrame:
    """(doc_id, dsir_score, attribute_score, selection_score), the first two scaled to [0, 1]."""
    cfg = fitted.cfg
    attribute = attribute_score(F.col("quality_class"), F.col("domain"), cfg)
    both = stage(
        importance_scores(docs, fitted, vecs).join(docs.select("doc_id", attribute.alias("attribute")), "doc_id"),
        "both_scores",
    )
    ends = both.agg(
        F.min("dsir").alias("d0"), F.max("dsir").alias("d1"),
        F.min("attribute").alias("a0"), F.max("attribute").alias("a1"),
    ).first()
    if ends["d0"] is None:  # no documents
        ends = {"d0": 0.0, "d1": 0.0, "a0": 0.0, "a1": 0.0}
    scaled = both.select(
        "doc_id",
        _unit_range("dsir", ends["d0"], ends["d1"]).alias("dsir_score"),
        _unit_range("attribute", ends["a0"], ends["a1"]).alias("attribute_score"),
    )
    combined = F.lit(cfg.importance_weight) * F.col("dsir_score") + F.lit(cfg.attribute_weight) * F.col("attribute_score")
    return scaled.withColumn("selection_score", F.round(combined, digits))


def to_selection_input(processed: DataFrame) -> DataFrame:
    """PROCESSED with the class under the name that later steps use."""
    return processed.select(
        "doc_id", "text", "domain", F.col("quality_class").alias("quality"),
        "quality_score", "toxicity_score", "metadata",
    )


def hybrid_select(processed: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """The selection step: SELECTED rows, or all rows if there are too few targets."""
    target = target_docs(processed, cfg)
    if not enough_targets(target, cfg):
        return to_selection_input(processed)
    if cfg.target_class == "medium":  # may list documents twice, so it is not a part of them
        scores = hybrid_scores(processed, fit_importance(target, cfg))
    else:
        scores = hybrid_scores(processed, *fit_within(processed, target_flag(processed, cfg), cfg))
    ranked = top_fraction(stage(scores, "hybrid_scores"), "selection_score", cfg.rate)
    return _with_rows(to_selection_input(processed), ranked, "hybrid")


def dsir_select_per_source(
    docs: DataFrame, fitted: Importance, by: str, rate: float | None = None
) -> DataFrame:
    """``dsir_select`` of every source on its own: each has its own distribution and share."""
    cfg = fitted.cfg
    rate = cfg.rate if rate is None else rate
    vecs = stage(tfidf.vectors(docs, fitted.vocabulary, cfg, keep=(by,)), "doc_terms")
    sizes = docs.groupBy(by).agg(F.count("*").alias("_docs"))
    means = vecs.groupBy(by, "term").agg(F.sum("tfidf").alias("_sum")).join(sizes, by)
    means = means.select(by, "term", (F.col("_sum") / F.col("_docs")).alias("_mean"))
    totals = means.groupBy(by).agg(F.sum("_mean").alias("_total"))
    # At most max_features rows per source, all of terms seen in it.
    source = means.join(totals, by).select(
        by, "term", (F.col("_mean") / (F.col("_total") + F.lit(_TINY))).alias("p_source")
    )
    ratio = F.coalesce("p", F.lit(0.0)) / (F.col("p_source") + F.lit(_TINY))
    weights = stage(
        source.join(fitted.target, "term", "left").select(
            by, "term", F.least(F.lit(10.0), F.greatest(F.lit(0.1), ratio)).alias("weight")
        ),
        "importance",
    )
    # A row per source and vocabulary term: few enough to be broadcast, unless there are very many sources.
    few = F.broadcast(weights) if weights.count() <= tfidf.BROADCAST_MAX_TERMS else weights
    summed = vecs.join(few, [by, "term"]).groupBy("doc_id").agg(
        F.sum(F.col("tfidf") * F.col("weight")).alias("_sum")
    )
    scores = stage(
        docs.select("doc_id", by).join(summed, "doc_id", "left").select(
            "doc_id", by, F.round(F.coalesce("_sum", F.lit(0.0)), 6).alias("selection_score")
        ),
        "dsir_scores",
    )
    ranked = top_fraction(scores, "selection_score", rate, within=by).drop(by)
    return _with_rows(docs, ranked, "dsir")
