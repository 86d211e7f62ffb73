"""Each operator as a query over the given tables: name -> (spark, folder) -> DataFrame.

Results are narrow and rounded so that they can be compared with ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamsift import schemas
from loamsift.config import SOURCE_CATALOG, CorpusConfig, SamplingConfig, SelectionConfig, SequenceConfig
from loamsift.functions.text import content_hash
from loamsift.functions.stopwords import ENGLISH
from loamsift.operators import bigrams, edits, exact, fuzzy, permutation, prep, quality, sampling, selection, stats, tfidf
from loamsift.operators.seen import SeenHashes
from loamsift.operators.staging import new_path, stage
from loamsift.plans import corpus
from loamsift.sources import documents as src
from loamsift.sources import jsonl, tables
from loamsift.streaming import documents as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; ``oracle`` uses the same.
PREFERENCES = {"web": 3.0, "books": 2.0, "code": 1.0}
UNIMAX_SIZE = 256
UNIMAX_BATCHES = (64, 12)
DRAW_SIZE = 2000
EPOCH = 1
SOME_BATCHES = (7, 12)  # the first and how many
TOXIC_LIMIT = 0.1
MAX_LENGTH = 2048
FILE_CHARS = 64_000_000  # of the texts of one written file


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_documents(spark, folder)


def _exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(tables.raw_documents(spark, folder, keep_stats=True))


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    return stage(quality.annotate(_exact(spark, folder)), "processed")


def _quality_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, domain, quality) for the samplers, which need no text."""
    scored = quality.annotate(_exact(spark, folder))
    return stage(scored.select("doc_id", "domain", F.col("quality_class").alias("quality")), "quality_rows")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.documents(spark, folder)


# --- sources and sinks -----------------------------------------------------------------


@query
def source_catalog(spark, folder):
    return src.source_report(_texts(spark, folder).select("domain"), SOURCE_CATALOG)


@query
def scan_source(spark, folder):
    scanned = src.union_all(tables.other_sources(spark, folder))
    return scanned.select("domain", "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@query
def file_positions(spark, folder):
    """A source of JSON files without ids, some large and some small: rows are numbered file by file."""
    docs, path = tables.table(spark, folder, "documents"), new_path(spark, "unnumbered")
    # Folders 0 to 2 by path, the middle one by far the largest. A file holds a range of ids, and its number stands first in its name.
    file = F.when(F.col("lang") == "en", 1).when(F.col("lang") < "en", 0).otherwise(2)
    rows = docs.select(file.alias("file"), "doc_id", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = rows.repartitionByRange(chars // FILE_CHARS + 1, "file", "doc_id").sortWithinPartitions("file", "doc_id")
    ranges.drop("doc_id").write.partitionBy("file").json(path)
    spec = replace(SOURCE_CATALOG[0], path=path)
    found = src.keyed(src.read_source(spark, spec))
    return found.select("doc_id", F.md5("text").alias("text_md5"))


def _per_domain(spark, folder, take) -> DataFrame:
    """``take`` of each domain, out of one written scan of the table."""
    docs = stage(_texts(spark, folder).select("doc_id", "text", "domain"), "scanned")
    return src.union_all([take(docs.where(F.col("domain") == spec.domain), spec) for spec in SOURCE_CATALOG])


@query
def prefix_scan(spark, folder):
    taken = _per_domain(spark, folder, lambda df, spec: src.prefix(df, 3 * spec.max_documents))
    return taken.select("doc_id", "domain", F.length("text").alias("n_chars"))


@query
def sample_source(spark, folder):
    def take(df, spec):
        return src.sample(src.prefix(df, 3 * spec.max_documents), spec.max_documents, 42)

    return _per_domain(spark, folder, take).select("doc_id", "domain", F.length("text").alias("n_chars"))


@query
def ingest_length_filter(spark, folder):
    return src.length_filter(_texts(spark, folder)).select("doc_id", "domain")


def _flat_raw(raw: DataFrame) -> DataFrame:
    return raw.select(
        "doc_id", "domain", "quality", "source", F.md5("text").alias("text_md5"),
        F.col("metadata.length").alias("length"), F.col("metadata.word_count").alias("word_count"),
        F.col("metadata.original_dataset").alias("original_dataset"), F.col("metadata.language").alias("language"),
    )


@query
def raw_documents(spark, folder):
    return _flat_raw(_raw(spark, folder))


@query
def ingest_sources(spark, folder):
    docs = _texts(spark, folder)
    scanned = {spec.domain: docs.where(F.col("domain") == spec.domain) for spec in SOURCE_CATALOG}
    return _flat_raw(corpus.ingest(scanned))


@query
def ingest_overlapping(spark, folder):
    """Sources whose ids overlap, and one without ids, numbered anew, then both kinds of duplicates dropped."""
    scanned, specs = {"web": _texts(spark, folder).withColumn("domain", F.lit("web"))}, [SOURCE_CATALOG[0]]
    for spec, id_column in tables.TABLE_SOURCES:
        rows = tables.table(spark, folder, spec.dataset)
        scanned[spec.domain] = src.scan(rows, spec, None if spec.dataset == "conversations" else id_column)
        specs.append(spec)
    cfg = CorpusConfig(sources=tuple(replace(spec, max_documents=1_000_000_000) for spec in specs))
    raw = stage(corpus.ingest(scanned, cfg), "ingested")  # texts meet their numbers once
    return corpus.process(raw, cfg).select("doc_id", "domain", "hash_id")


@query
def domain_mix_gap(spark, folder):
    gap = src.domain_mix_gap(_texts(spark, folder), SOURCE_CATALOG)
    return gap.select("domain", "weight", r6("share").alias("share"), r6("gap").alias("gap"))


@query
def union_sources(spark, folder):
    frames = [_texts(spark, folder), *tables.other_sources(spark, folder)]
    return stats.count_by(src.to_raw(src.union_all(frames)), "domain", "quality")


@query
def jsonl_roundtrip(spark, folder):
    path = new_path(spark, "raw_jsonl")
    jsonl.write_jsonl(_raw(spark, folder), path, by="domain")
    return _flat_raw(jsonl.read_jsonl(spark, path, schemas.RAW))


def _flat_processed(df: DataFrame) -> DataFrame:
    checks = "metadata.filter_results."
    return df.select(
        "doc_id", "domain", "quality_class", r6("quality_score").alias("quality_score"),
        r6("toxicity_score").alias("toxicity_score"), "hash_id", "is_duplicate",
        r6("metadata.perplexity").alias("perplexity"), "metadata.original_quality",
        F.col(checks + "passes").alias("passes"), F.col(checks + "reason").alias("reason"),
    )


@query
def processed_sink(spark, folder):
    path = new_path(spark, "processed_jsonl")
    jsonl.write_jsonl(jsonl.finite_perplexity(quality.annotate(_exact(spark, folder))), path)
    return _flat_processed(jsonl.read_jsonl(spark, path, schemas.PROCESSED))


def _flat_selected(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", "domain", "quality", r6("selection_score").alias("selection_score"),
        r6("dsir_score").alias("dsir_score"), r6("attribute_score").alias("attribute_score"),
        "selection_rank", "selected_by",
    )


@query
def selected_sink(spark, folder):
    path = new_path(spark, "selected_jsonl")
    selected = selection.hybrid_select(_processed(spark, folder))
    jsonl.write_jsonl(jsonl.finite_perplexity(selected), path)
    return _flat_selected(jsonl.read_jsonl(spark, path, selected.schema))


@query
def raw_stats(spark, folder):
    one = stats.raw_stats(_raw(spark, folder))
    return one.select("total_documents", F.explode("domain_counts").alias("domain", "documents"))


@query
def processing_stats(spark, folder):
    one = stats.processing_stats(quality.annotate(_exact(spark, folder)))
    return one.select(
        "total_processed", "quality_distribution.high", "quality_distribution.medium", "quality_distribution.low",
        r6("avg_quality_score").alias("avg_quality_score"), r6("avg_toxicity_score").alias("avg_toxicity_score"),
        F.explode("domain_distribution").alias("domain", "documents"),
    )


@query
def stage_counts(spark, folder):
    raw = tables.raw_documents(spark, folder, keep_stats=True)
    processed = stage(corpus.process(raw), "processed")
    selected = stage(corpus.select(processed).drop("text"), "selected")  # nothing after it reads texts
    splits = prep.train_eval_split(selected)
    return stats.stage_counts({
        "raw": raw, "processed": processed, "selected": selected,
        "sampled": corpus.sample(selected), "train": splits.where("split = 'train'"),
        "eval": splits.where("split = 'eval'"),
    })


# --- row-local scores ------------------------------------------------------------------


def _ingest_quality(spark, folder, domain: Column) -> DataFrame:
    df = quality.with_text_stats(_texts(spark, folder))
    return df.select("doc_id", "domain", quality.ingest_quality(domain).alias("quality"))


@query
def estimate_quality(spark, folder):
    return _ingest_quality(spark, folder, F.col("domain"))


@query
def estimate_quality_code(spark, folder):
    return _ingest_quality(spark, folder, F.lit("code"))


@query
def estimate_quality_academic(spark, folder):
    return _ingest_quality(spark, folder, F.lit("academic"))


@query
def perplexity_score(spark, folder):
    df = quality.with_text_stats(_texts(spark, folder))
    return df.select("doc_id", r6(quality.perplexity()).alias("perplexity"))


@query
def heuristic_filters(spark, folder):
    df = quality.with_text_stats(_texts(spark, folder), F.col("domain") == "code").withColumn(
        "_r", quality.filter_results(F.col("domain"))
    )
    return df.select("doc_id", "_r.*", quality.passes(F.col("_r")).alias("passes"))


@query
def page_filters(spark, folder):
    """The same checks on raw html, which has links and many signs."""
    pages = tables.table(spark, folder, "pages").select("page_id", F.col("html").alias("text"))
    df = quality.with_text_stats(pages, F.lit(False)).withColumn("_r", quality.filter_results(F.lit("web")))
    return df.select(
        "page_id", F.col("_r.url_ratio_ok"), F.col("_r.non_alpha_ok"), F.col("_r.number_ratio_ok"),
        F.col("_r.word_length_ok"), quality.passes(F.col("_r")).alias("passes"),
    )


@query
def code_filters(spark, folder):
    df = quality.with_text_stats(_texts(spark, folder), F.lit(True))
    length_ok, comment_ok = quality.code_checks()
    return df.select("doc_id", length_ok.alias("code_length_ok"), comment_ok.alias("code_comment_ok"))


@query
def quality_class(spark, folder):
    annotated = quality.annotate(exact.with_hash(_raw(spark, folder)).withColumn("is_duplicate", F.lit(False)))
    return annotated.select("doc_id", "domain", "quality_class")


@query
def quality_score(spark, folder):
    df = quality.with_text_stats(_texts(spark, folder))
    return df.select("doc_id", r6(quality.quality_score(quality.perplexity())).alias("quality_score"))


@query
def toxicity_score(spark, folder):
    return _texts(spark, folder).select("doc_id", r6(quality.toxicity(F.col("text"))).alias("toxicity_score"))


@query
def annotate_quality(spark, folder):
    return _flat_processed(quality.annotate(_exact(spark, folder)))


@query
def quality_drop(spark, folder):
    return quality.quality_drop(quality.annotate(_exact(spark, folder))).select("doc_id", "domain", "quality_class")


@query
def toxicity_filter(spark, folder):
    scored = quality.annotate(_exact(spark, folder)).select("doc_id", "toxicity_score")
    clean = quality.toxicity_filter(scored, TOXIC_LIMIT).withColumn("side", F.lit("below"))
    toxic = quality.toxicity_filter(scored, TOXIC_LIMIT, keep="above").withColumn("side", F.lit("above"))
    return clean.unionByName(toxic).select("doc_id", "side")


@query
def ngram_signature(spark, folder):
    signed = fuzzy.with_tokens(_texts(spark, folder)).select(
        "doc_id", fuzzy.ngram_signature(F.col("_tokens")).alias("grams")
    )
    return signed.select(
        "doc_id", F.size("grams").alias("n_grams"),
        F.md5(F.array_join(F.array_sort("grams"), "|")).alias("grams_md5"),
    )


@query
def content_hashes(spark, folder):
    text = F.col("text")
    return _texts(spark, folder).select(
        "doc_id", content_hash(text, "md5").alias("md5"), content_hash(text, "sha256").alias("sha256")
    )


def _bigram_model(spark, folder) -> tuple[DataFrame, DataFrame, bigrams.BigramModel]:
    """The processed documents, the counts of their pairs, and a model of the target ones among them."""
    processed = quality.annotate(_exact(spark, folder))
    counts = bigrams.pair_counts(processed, selection.target_flag(processed))
    return processed, counts, bigrams.fit_counts(counts)


@query
def bigram_model(spark, folder):
    """Sizes of the fitted tables and the mean of their columns."""
    _, _, model = _bigram_model(spark, folder)
    parts = {"pairs": (model.pairs, "seen"), "contexts": (model.contexts, "back_off"), "words": (model.words, "chance")}
    return src.union_all([
        table.agg(F.count("*").alias("rows"), r6(F.avg(column)).alias("mean")).select(F.lit(name).alias("part"), "rows", "mean")
        for name, (table, column) in parts.items()
    ])


@query
def bigram_perplexity(spark, folder):
    processed, counts, model = _bigram_model(spark, folder)
    scores = bigrams.perplexity(processed, model, counts)
    return scores.select("doc_id", "n_tokens", "n_known", r6("log10_perplexity").alias("log10_perplexity"))


@query
def bigram_filter(spark, folder):
    """Documents under the trained model's threshold."""
    processed, counts, model = _bigram_model(spark, folder)
    limit = CorpusConfig().quality.perplexity_threshold
    return bigrams.perplexity_filter(processed, bigrams.perplexity(processed, model, counts), limit).select("doc_id", "domain")


# --- duplicates ------------------------------------------------------------------------


@query
def exact_dedup(spark, folder):
    return exact.exact_dedup(_texts(spark, folder)).select("doc_id", "domain", "hash_id", "is_duplicate")


@query
def exact_dedup_last(spark, folder):
    """The last copy stays instead of the first."""
    return exact.exact_dedup(_texts(spark, folder), "xxhash", keep="last").select("doc_id", "domain", F.md5("text").alias("text_md5"))


@query
def exact_dup_flags(spark, folder):
    return exact.exact_dup_flags(_texts(spark, folder)).select("doc_id", "hash_id", "is_duplicate")


@query
def exact_dup_audit(spark, folder):
    return exact.exact_dup_audit(_texts(spark, folder)).select("doc_id", "hash_id", "first_doc_id")


@query
def exact_dedup_incremental(spark, folder):
    """The domains as batches one after the other; each is checked against all before it."""
    docs = _texts(spark, folder).select("doc_id", "text", "domain")
    seen, kept = None, []
    for number, spec in enumerate(SOURCE_CATALOG):
        batch = docs.where(F.col("domain") == spec.domain)
        survivors = stage(
            exact.exact_dedup_incremental(batch, seen).select("doc_id", "hash_id", F.lit(number).alias("batch")),
            "survivors",
        )
        kept.append(survivors)
        seen = survivors if seen is None else seen.unionByName(survivors)
    return src.union_all(kept)


@query
def exact_dedup_store(spark, folder):
    """The same batches against a written store of hashes."""
    docs = _texts(spark, folder).select("doc_id", "text", "domain")
    store, kept = SeenHashes(spark, new_path(spark, "seen")), []
    for number, spec in enumerate(SOURCE_CATALOG):
        batch = docs.where(F.col("domain") == spec.domain)
        survivors = exact.exact_dedup_with_store(batch, store, number).select("doc_id", "hash_id", F.lit(number).alias("batch"))
        kept.append(stage(survivors, "survivors"))
        store.add(kept[-1], number)
    return src.union_all(kept)


@query
def shingle_profile(spark, folder):
    """Per document: 3-grams, those other documents have too, and those used as join keys."""
    sets = fuzzy.shingle_sets(_exact(spark, folder).select("doc_id", "text"))
    return sets.select("doc_id", "n_shingles", "n_shared", "n_prefix")


@query
def fuzzy_matches(spark, folder):
    docs = _exact(spark, folder).select("doc_id", "text")  # read once
    return fuzzy.fuzzy_matches(docs).select("doc_id", "kept_id", r6("similarity").alias("similarity"))


@query
def fuzzy_dedup(spark, folder):
    """Every exact survivor with the mark and the hash of the first kept match."""
    flagged = fuzzy.fuzzy_flags(_exact(spark, folder).select("doc_id", "text", "hash_id"))  # texts are read once, hashes again
    return flagged.select("doc_id", "is_duplicate", "similar_to")


@query
def edit_matches(spark, folder):
    """Each exact survivor that differs in few characters from an earlier kept one."""
    return edits.edit_matches(_exact(spark, folder)).select("doc_id", "kept_id", r6("similarity").alias("similarity"))


@query
def process_dataset(spark, folder):
    return _flat_processed(corpus.process(tables.raw_documents(spark, folder, keep_stats=True)))


# --- counts ----------------------------------------------------------------------------


@query
def quality_distribution(spark, folder):
    return stats.quality_distribution(quality.annotate(_exact(spark, folder)))


@query
def quality_by_domain(spark, folder):
    return stats.count_by(quality.annotate(_exact(spark, folder)), "domain", "quality_class")


@query
def domain_distribution(spark, folder):
    return stats.count_by(_exact(spark, folder), "domain")


@query
def avg_scores(spark, folder):
    means = stats.average_scores(quality.annotate(_exact(spark, folder)))
    return means.select(*[r6(c).alias(c) for c in means.columns])


@query
def ingest_quality_by_domain(spark, folder):
    return stats.count_by(_raw(spark, folder), "domain", "quality")


@query
def domain_statistics(spark, folder):
    groups = sampling.group_statistics(_texts(spark, folder))
    return groups.select("domain", "count", r6("proportion").alias("proportion"), "first_id")


@query
def attribute_buckets(spark, folder):
    return stats.count_by(sampling.with_buckets(_quality_rows(spark, folder)), "bucket")


@query
def attribute_buckets_grouped(spark, folder):
    return stats.count_by(sampling.with_buckets(_quality_rows(spark, folder), fine=False), "bucket")


@query
def batch_composition(spark, folder):
    batch = sampling.unimax_batch(_quality_rows(spark, folder), UNIMAX_SIZE)
    return stats.count_by(batch, "domain")


@query
def sampler_choice(spark, folder):
    return sampling.method_by_composition(_texts(spark, folder))


# --- selection -------------------------------------------------------------------------


@query
def target_docs(spark, folder):
    return selection.target_docs(_processed(spark, folder)).select("doc_id", F.md5("text").alias("text_md5"))


@query
def selection_guard(spark, folder):
    """By class: would it make a target set, alone or with the medium class?"""
    processed = _processed(spark, folder)
    rows = []
    for name in stats.CLASSES:
        cfg = SelectionConfig(target_class=name)
        target = selection.target_docs(processed, cfg)
        rows.append(target.agg(F.count("*").alias("targets")).select(
            F.lit(name).alias("target_class"), "targets", F.lit(selection.enough_targets(target, cfg)).alias("select"),
        ))
    return src.union_all(rows)


@query
def dsir_terms(spark, folder):
    terms = tfidf.with_terms(_texts(spark, folder), ENGLISH)
    return terms.select(
        "doc_id", F.size("terms").alias("n_terms"), F.md5(F.array_join("terms", "|")).alias("terms_md5")
    )


def _fitted(spark, folder) -> tuple[DataFrame, selection.Importance]:
    processed = _processed(spark, folder)
    return processed, selection.fit_importance(selection.target_docs(processed))


@query
def tfidf_vocab(spark, folder):
    vocabulary, _ = tfidf.fit_vocabulary(selection.target_docs(_processed(spark, folder)))
    return vocabulary.select("term", "df", "total", r6("idf").alias("idf"))


@query
def tfidf_vectors(spark, folder):
    processed = _processed(spark, folder)
    vocabulary, _ = tfidf.fit_vocabulary(selection.target_docs(processed))
    return tfidf.vectors(processed, vocabulary).select("doc_id", "term", "tf", r6("tfidf").alias("tfidf"))


@query
def target_distribution(spark, folder):
    _, fitted = _fitted(spark, folder)
    return fitted.target.select("term", F.round("p", 9).alias("p"))


def _source_distribution(processed, fitted) -> DataFrame:
    vecs = tfidf.vectors(processed, fitted.vocabulary)
    return tfidf.distribution(vecs, processed.count(), 1e-10)


@query
def source_distribution(spark, folder):
    return _source_distribution(*_fitted(spark, folder)).select("term", F.round("p", 9).alias("p"))


@query
def importance_weights(spark, folder):
    processed, fitted = _fitted(spark, folder)
    weights = tfidf.importance(fitted.vocabulary, fitted.target, _source_distribution(processed, fitted))
    return weights.select("term", r6("weight").alias("weight"))


def _fitted_within(spark, folder) -> tuple[DataFrame, selection.Importance, DataFrame]:
    processed = _processed(spark, folder)
    return processed, *selection.fit_within(processed, selection.target_flag(processed))


@query
def dsir_scores(spark, folder):
    return selection.importance_scores(*_fitted_within(spark, folder))


def _picked(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "domain", r6("selection_score").alias("selection_score"), "selection_rank", "selected_by")


@query
def dsir_select(spark, folder):
    return _picked(selection.dsir_select(*_fitted_within(spark, folder)))


@query
def dsir_select_per_source(spark, folder):
    processed, fitted = _fitted(spark, folder)
    return _picked(selection.dsir_select_per_source(processed, fitted, "domain"))


def _attribute_scores(spark, folder, include_scores) -> DataFrame:
    score = selection.attribute_score(F.col("quality_class"), F.col("domain"), include_scores=include_scores)
    return quality.annotate(_exact(spark, folder)).select("doc_id", r6(score).alias("attribute_score"))


@query
def attribute_score(spark, folder):
    return _attribute_scores(spark, folder, False)


@query
def attribute_score_full(spark, folder):
    return _attribute_scores(spark, folder, True)


@query
def attribute_select(spark, folder):
    return _picked(selection.attribute_select(_processed(spark, folder)))


@query
def attribute_share(spark, folder):
    """The same documents without ranks."""
    shared = selection.attribute_share(_processed(spark, folder))
    return shared.select("doc_id", "domain", r6("selection_score").alias("selection_score"))


@query
def hybrid_scores(spark, folder):
    scores = selection.hybrid_scores(*_fitted_within(spark, folder))
    return scores.select("doc_id", *[r6(c).alias(c) for c in ("dsir_score", "attribute_score", "selection_score")])


@query
def hybrid_select(spark, folder):
    return _flat_selected(selection.hybrid_select(_processed(spark, folder)))


# --- sampling --------------------------------------------------------------------------


def _weights(weights: DataFrame, by: str = "domain") -> DataFrame:
    return weights.select(by, r6("weight").alias("weight"))


@query
def unimax_weights(spark, folder):
    return _weights(sampling.unimax_weights(sampling.group_statistics(_texts(spark, folder))))


@query
def alpha_weights(spark, folder):
    return _weights(sampling.alpha_weights(sampling.group_statistics(_texts(spark, folder)), 1.3))


@query
def alpha_weights_by_lang(spark, folder):
    stats_ = sampling.group_statistics(_texts(spark, folder), "language")
    return _weights(sampling.alpha_weights(stats_, 1.3, "language"), "language")


@query
def preference_weights(spark, folder):
    return _weights(sampling.preference_weights(sampling.group_statistics(_texts(spark, folder)), PREFERENCES))


@query
def attribute_bucket_weights(spark, folder):
    buckets = sampling.with_buckets(_quality_rows(spark, folder))
    return _weights(sampling.bucket_weights(sampling.group_statistics(buckets, "bucket")), "bucket")


@query
def unimax_batch(spark, folder):
    return sampling.unimax_batch(_texts(spark, folder), UNIMAX_SIZE)


@query
def unimax_batches(spark, folder):
    return sampling.unimax_batches(_texts(spark, folder), *UNIMAX_BATCHES, SamplingConfig(max_epochs=2))


@query
def unimax_continued(spark, folder):
    """The same batches by three runs, each going on from the written state of the one before."""
    docs, state, found = _texts(spark, folder), None, []
    for n_batches in (1, 4, UNIMAX_BATCHES[1] - 5):
        batches, state = sampling.unimax_run(docs, UNIMAX_BATCHES[0], n_batches, SamplingConfig(max_epochs=2), state=state)
        state = stage(state, "round_robin_state")
        found.append(batches)
    return src.union_all(found)


@query
def alpha_batch(spark, folder):
    return sampling.alpha_batch(_texts(spark, folder), DRAW_SIZE)


@query
def alpha_batches_indexed(spark, folder):
    """The same draws in two batches from an index that is written once."""
    docs = _texts(spark, folder)
    index, half = sampling.alpha_index(docs), DRAW_SIZE // 2
    n_draws = min(DRAW_SIZE, docs.count())
    return index.draws(0, min(half, n_draws)).unionByName(index.draws(half, max(0, n_draws - half)))


@query
def alpha_batch_documented(spark, folder):
    return sampling.alpha_batch(_texts(spark, folder), DRAW_SIZE, documented=True)


@query
def preference_batch(spark, folder):
    return sampling.preference_batch(_texts(spark, folder), PREFERENCES, DRAW_SIZE)


@query
def attribute_batch(spark, folder):
    return sampling.attribute_batch(_quality_rows(spark, folder), DRAW_SIZE)


@query
def fit_passthrough(spark, folder):
    weighted = sampling.with_sampling_weight(_texts(spark, folder).select("doc_id", "domain"))
    return weighted.select("doc_id", "domain", "sampling_method", r6("sampling_weight").alias("sampling_weight"))


# --- sequences -------------------------------------------------------------------------


@query
def train_eval_split(spark, folder):
    return prep.train_eval_split(selection.attribute_select(_processed(spark, folder)))


@query
def token_encode(spark, folder):
    coded = prep.encode_documents(_texts(spark, folder))
    return coded.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", ",")).alias("tokens_md5")
    )


@query
def pad_truncate(spark, folder):
    fitted = prep.padded(_texts(spark, folder), SequenceConfig(max_length=MAX_LENGTH))
    return fitted.select("doc_id", F.size("tokens").alias("length"), F.md5(F.array_join("tokens", ",")).alias("tokens_md5"))


@query
def training_sequences(spark, folder):
    rows = prep.training_sequences(_texts(spark, folder), SequenceConfig(max_length=MAX_LENGTH))
    return rows.select(
        "doc_id", "n_tokens", F.size("input_ids").alias("length"),
        F.md5(F.array_join("input_ids", ",")).alias("input_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.size(F.filter("attention_mask", lambda m: m)).alias("attended"),
    )


@query
def epoch_batches(spark, folder):
    return prep.epoch_batches(_texts(spark, folder).select("doc_id"), EPOCH)


@query
def epoch_order(spark, folder):
    """An epoch's batches by a keyed bijection of dense numbers."""
    return permutation.epoch_order(*permutation.numbered(_texts(spark, folder)), EPOCH)


@query
def epoch_some_batches(spark, folder):
    """A run of batches in the middle of the same epoch, looked up from their places."""
    return permutation.epoch_batch(*permutation.numbered(_texts(spark, folder)), EPOCH, *SOME_BATCHES)


@query
def eval_batches(spark, folder):
    return prep.epoch_batches(_texts(spark, folder).select("doc_id"), shuffle=False)


@query
def token_counts(spark, folder):
    docs = _texts(spark, folder).select("doc_id", "domain", "text")
    return prep.token_totals(docs, prep.train_eval_split(docs))


# --- streams ---------------------------------------------------------------------------


def _as_stream(spark, df: DataFrame) -> DataFrame:
    path = new_path(spark, "stream_in")
    df.repartitionByRange(4, "doc_id").write.parquet(path)
    return streaming.read_stream(spark, path, df.schema, files_per_trigger=1)


def _drained(spark, stream: DataFrame) -> DataFrame:
    out = new_path(spark, "stream_out")
    streaming.write_stream(stream, out, new_path(spark, "stream_state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_exact_dedup(spark, folder):
    unique = streaming.dedup(_as_stream(spark, _texts(spark, folder).select("doc_id", "text")))
    return _drained(spark, unique).select("hash_id", F.length("text").alias("n_chars"))


@query
def stream_dedup_batches(spark, folder):
    """The domains arrive one after the other; the stream is started again for each."""
    docs = _texts(spark, folder).select("doc_id", "text", "domain")
    arrived, out, state = (new_path(spark, name) for name in ("stream_in", "stream_out", "stream_state"))
    for spec in SOURCE_CATALOG:
        docs.where(F.col("domain") == spec.domain).write.mode("append").parquet(arrived)
        stream = streaming.read_stream(spark, arrived, docs.schema, files_per_trigger=1000)
        streaming.dedup_batches(stream, out, state).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "hash_id", F.col("batch").cast("int").alias("batch"))


@query
def stream_annotate(spark, folder):
    scored = _drained(spark, streaming.annotate(_as_stream(spark, _texts(spark, folder))))
    return scored.select("doc_id", "quality_class", r6("quality_score").alias("quality_score"), "hash_id")
