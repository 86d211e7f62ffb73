"""Row-local scores and filters. Nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.config import QualityConfig
from loamsift.functions import text as tx

# Terms whose presence as a substring counts towards toxicity.
TOXIC_TERMS = (
    "hate", "violence", "threat", "attack", "kill", "die", "stupid", "idiot",
    "racist", "sexist", "discrimination", "harassment",
)
TOXIC_SCALE = 10.0

# Perplexity estimate.
PERPLEXITY_SCALE = 1000.0
PERPLEXITY_SMOOTHING = 0.1

# Markers of comments, code structure and citations, and ingest limits.
COMMENT_MARKERS = ("#", "//", "/*")
STRUCTURE_WORDS = ("def", "function", "class", "import", "return")
CITATION_MARKERS = ("et al.", "Figure", "Table", "Abstract")

CHECKS = (
    "length_ok", "word_length_ok", "non_alpha_ok", "number_ratio_ok",
    "url_ratio_ok", "duplicate_lines_ok", "code_length_ok", "code_comment_ok",
)


def with_text_stats(df: DataFrame, code: Column | None = None) -> DataFrame:
    """Add the counts that the scores below share, each computed once per row.

    The word and line arrays stay in their own projection, so that splitting a long text
    is not repeated for every expression that needs its size. Rows where ``code`` holds get
    counts of source and comment lines too.
    """
    split = df.withColumn("_lines", tx.lines(F.col("text")))
    counts = {}
    if "_n_words" not in df.columns:  # else they were counted on ingest
        split = split.withColumn("_words", tx.words(F.col("text")))
        counts = {
            "_n_chars": F.length("text"),
            "_n_words": F.size("_words"),
            "_n_unique_words": F.size(F.array_distinct("_words")),
            "_n_lines": F.size("_lines"),
            "_n_unique_lines": F.size(F.array_distinct("_lines")),
            "_n_word_chars": tx.total_length(F.col("_words")),
            "_n_symbols": tx.symbol_chars(F.col("text")),
        }
    if code is not None:
        nonblank, note = rf"{tx.UNICODE}[^{tx.WHITESPACE}]", rf"{tx.UNICODE}^[{tx.WHITESPACE}]*(#|//)|/\*"
        split = split.withColumn("_source", F.when(code, F.filter("_lines", lambda line: line.rlike(nonblank))))
        counts["_n_source_lines"] = F.size("_source")
        counts["_n_comment_lines"] = F.when(code, F.size(F.filter("_source", lambda line: line.rlike(note))))
    return split.withColumns(counts).drop("_words", "_lines", "_source")


def _ratio(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def mean_word_length() -> Column:
    return _ratio(F.col("_n_word_chars"), F.col("_n_words"))


def ingest_quality(domain: Column) -> Column:
    """Class given on ingest, from simple signs that differ for code and academic text."""
    text, n_words = F.col("text"), F.col("_n_words")
    symbols = _ratio(F.col("_n_symbols"), F.col("_n_chars"))
    upper = _ratio(tx.uppercase_chars(text), F.col("_n_chars"))

    structure = tx.contains_any(F.lower(text), STRUCTURE_WORDS)
    comments = tx.contains_any(text, COMMENT_MARKERS)
    code = F.when(comments & structure & (n_words > 20), "high").when(
        structure & (n_words > 10), "medium"
    ).otherwise("low")

    formal = (mean_word_length() > 5) & (symbols < 0.1)
    cites = tx.contains_any(text, CITATION_MARKERS)
    academic = F.when(cites & formal & (n_words > 100), "high").when(
        formal & (n_words > 50), "medium"
    ).otherwise("low")

    general = F.when(
        (n_words > 100) & (mean_word_length() > 4) & (symbols < 0.15) & (upper < 0.3), "high"
    ).when((n_words > 50) & (mean_word_length() > 3) & (symbols < 0.25), "medium").otherwise("low")

    return F.when(domain == "code", code).when(domain == "academic", academic).otherwise(general)


def perplexity(cfg: QualityConfig = QualityConfig()) -> Column:
    variety = _ratio(F.col("_n_unique_words"), F.col("_n_words"))
    score = F.lit(PERPLEXITY_SCALE) * (F.lit(1.0) / (mean_word_length() * variety + F.lit(PERPLEXITY_SMOOTHING)))
    return F.when(F.col("_n_words") == 0, F.lit(float("inf"))).otherwise(
        F.least(score, F.lit(2 * cfg.perplexity_threshold))
    )


def code_checks(cfg: QualityConfig = QualityConfig()) -> tuple[Column, Column]:
    """Number of non-blank lines in range, and share of comment lines in range."""
    n = F.col("_n_source_lines")
    return (
        n.between(cfg.code_min_lines, cfg.code_max_lines),
        _ratio(F.col("_n_comment_lines"), n).between(cfg.code_min_comment_ratio, cfg.code_max_comment_ratio),
    )


def filter_results(domain: Column, cfg: QualityConfig = QualityConfig()) -> Column:
    """Struct of every check. Checks that do not apply to a row are null and do not count."""
    text, n_chars, n_words = F.col("text"), F.col("_n_chars"), F.col("_n_words")
    is_empty = n_words == 0
    code_length_ok, code_comment_ok = code_checks(cfg)
    checks = {
        "length_ok": n_words.between(cfg.min_words, cfg.max_words),
        "word_length_ok": mean_word_length().between(cfg.min_word_length, cfg.max_word_length),
        "non_alpha_ok": _ratio(F.col("_n_symbols"), n_chars) <= cfg.max_symbol_ratio,
        "number_ratio_ok": _ratio(tx.digit_chars(text), n_chars) <= cfg.max_digit_ratio,
        "url_ratio_ok": _ratio(tx.url_count(text), n_words) <= cfg.max_url_ratio,
        "duplicate_lines_ok": F.lit(1.0) - F.col("_n_unique_lines") / F.col("_n_lines")
        <= cfg.max_duplicate_line_ratio,
        "code_length_ok": F.when(domain == "code", code_length_ok),
        "code_comment_ok": F.when(domain == "code", code_comment_ok),
    }
    checks = {name: F.when(~is_empty, check) for name, check in checks.items()}
    return F.struct(
        *[check.alias(name) for name, check in checks.items()],
        F.when(is_empty, F.lit("empty_text")).alias("reason"),
    )


def passes(results: Column) -> Column:
    every = results["reason"].isNull()
    for name in CHECKS:
        every = every & F.coalesce(results[name], F.lit(True))
    return every


def quality_class(ppl: Column, ok: Column, cfg: QualityConfig = QualityConfig()) -> Column:
    limit = cfg.perplexity_threshold
    return (
        F.when(~ok | (ppl > limit), "low")
        .when(ppl <= limit * cfg.high_share, "high")
        .when(ppl <= limit * cfg.medium_share, "medium")
        .otherwise("low")
    )


def quality_score(ppl: Column, cfg: QualityConfig = QualityConfig()) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - ppl / F.lit(2 * cfg.perplexity_threshold))


def toxicity(text: Column, terms: tuple[str, ...] = TOXIC_TERMS) -> Column:
    lowered = F.lower(text)
    hits = F.lit(0)
    for term in terms:
        hits = hits + F.contains(lowered, F.lit(term)).cast("int")
    return F.least(hits / F.lit(TOXIC_SCALE), F.lit(1.0))


def annotate(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Score every document and keep all of them: RAW plus dedup marks in, PROCESSED out.

    Counts that ingest kept (``to_raw`` with ``keep_stats``) aren't made again.
    """
    scored = (
        with_text_stats(df, F.col("domain") == "code")
        .withColumns({"_ppl": perplexity(cfg), "_checks": filter_results(F.col("domain"), cfg)})
        .withColumn("_passes", passes(F.col("_checks")))
    )
    meta = F.col("metadata")
    checks = F.col("_checks")
    reason = checks["reason"].alias("reason")
    return scored.select(
        "doc_id",
        "text",
        "domain",
        quality_score(F.col("_ppl"), cfg).alias("quality_score"),
        quality_class(F.col("_ppl"), F.col("_passes"), cfg).alias("quality_class"),
        toxicity(F.col("text")).alias("toxicity_score"),
        "hash_id",
        "is_duplicate",
        F.struct(
            *[meta[f].alias(f) for f in ("length", "word_count", "original_dataset", "language", "title")],
            F.col("_ppl").alias("perplexity"),
            F.coalesce(F.col("quality"), F.lit("unknown")).alias("original_quality"),
            F.struct(*[checks[n].alias(n) for n in CHECKS], F.col("_passes").alias("passes"), reason).alias(
                "filter_results"
            ),
        ).alias("metadata"),
    )


def quality_drop(processed: DataFrame, classes: tuple[str, ...] = ("low",)) -> DataFrame:
    """Without the documents that fail a check or are in one of ``classes``."""
    low = F.coalesce(F.col("quality_class").isin(*classes), F.lit(True))
    return processed.where(F.col("metadata.filter_results.passes") & ~low)


def toxicity_filter(processed: DataFrame, limit: float, keep: str = "below") -> DataFrame:
    """Documents with a score below ``limit``, or for a detector's corpus those at or above it."""
    if keep not in ("below", "above"):
        raise ValueError(f"keep is 'below' or 'above', not {keep!r}")
    score = F.coalesce("toxicity_score", F.lit(0.0))
    return processed.where(score < limit if keep == "below" else score >= limit)
