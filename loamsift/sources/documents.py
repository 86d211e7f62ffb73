"""Reading declared sources into the RAW layout."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamsift.config import IngestConfig, SourceSpec
from loamsift.functions.seeded import uniform
from loamsift.functions import text as tx
from loamsift.operators import quality
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import stage

MAX_SINGLE_MERGE = 100_000
MAX_BROADCAST_SPLITS = 100_000


def scan(df: DataFrame, spec: SourceSpec, id_column: str | None = "doc_id") -> DataFrame:
    """Project a source to (doc_id, text, domain, source, language, title).

    Without an id column ``doc_id`` is null until ``keyed`` numbers the rows.
    """
    own_id = F.col(id_column) if id_column in df.columns else F.lit(None)

    def optional(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    return df.select(
        own_id.cast("bigint").alias("doc_id"),
        F.col(spec.text_column).alias("text"),
        F.lit(spec.domain).alias("domain"),
        F.coalesce(optional("source"), F.lit(spec.dataset)).alias("source"),
        optional("language").alias("language"),
        optional("title").alias("title"),
    )


def read_source(spark: SparkSession, spec: SourceSpec, id_column: str = "doc_id") -> DataFrame:
    """Scan the files of ``spec.path``; only the mapped columns are read."""
    schema = f"{id_column} bigint, `{spec.text_column}` string, source string, language string, title string"
    reader = spark.read.format(spec.format)
    if spec.format in ("json", "csv"):
        reader = reader.schema(schema)
    return scan(reader.load(spec.path), spec, id_column)


def keyed(df: DataFrame) -> DataFrame:
    """``df`` with an id in every row: its own, or without any its position in its files."""
    known = df.agg(F.count("doc_id").alias("ids"), F.count("*").alias("rows")).first()
    if known["ids"] == known["rows"]:
        return df
    if known["ids"]:
        raise ValueError("some rows of a source have an id and some have none")
    return positions(df)


def positions(df: DataFrame) -> DataFrame:
    """``df`` with its rows numbered from 0 file by file, by path, and in each file from its beginning.

    Spark reads large files first and cuts them into splits, so the order of its partitions says nothing.
    A row's place is known within its split, and the splits (one row each) are put in order by path and
    offset: the same numbers come out whatever the size of files and splits. A frame that isn't read from
    files is numbered in the order of its partitions.
    """
    try:
        placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start")})
    except AnalysisException:
        placed = df.withColumns({"_file": F.lit(""), "_split": F.spark_partition_id().cast("bigint")})
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()), "placed")
    splits = stage(placed.groupBy("_file", "_split").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows")), "splits")
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_file", "_split", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    if splits.count() <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    numbered = placed.join(starts, ["_file", "_split"]).withColumn("doc_id", (F.col("_place") + F.col("_start")).cast("bigint"))
    return numbered.select(*df.columns)


def check_ids(df: DataFrame) -> DataFrame:
    """``df`` itself, if every row has an id and no two have the same."""
    bad = df.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id IS NULL OR n > 1").head(1)
    if bad:
        raise ValueError(f"doc_id {bad[0]['doc_id']} stands in {bad[0]['n']} rows: ids must be unique and not null")
    return df


def union_with_ids(frames: list[DataFrame]) -> DataFrame:
    """All rows with a new, unique ``doc_id``: source by source, in each in the order of its own ids.

    Older documents thus have smaller ids. The id within the source is kept as ``source_key``.
    """
    parts = [df.withColumn("_source", F.lit(number)) for number, df in enumerate(frames)]
    rows = union_all(parts).withColumnRenamed("doc_id", "source_key")
    keys = stage(rows.select("_source", "source_key"), "source_keys")  # texts are read again and move once, by the join
    twice = keys.groupBy("_source", "source_key").agg(F.count("*").alias("n")).where("source_key IS NULL OR n > 1").head(1)
    if twice:
        raise ValueError(f"source {twice[0]['_source']} has {twice[0]['n']} rows with the id {twice[0]['source_key']}")
    ids = add_rank(keys, [F.col("_source"), F.col("source_key")], "doc_id")
    joined = rows.join(ids, ["_source", "source_key"])
    return joined.select("doc_id", *[name for name in frames[0].columns if name != "doc_id"], "source_key")


def _first(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``: only ids are sorted, the text follows by semi-join. No more rows than that all stay where they are."""
    ids = df.select("doc_id")
    if n <= MAX_SINGLE_MERGE:
        kept = ids.orderBy(*order).limit(n)
    elif ids.count() <= n:
        return df.where(F.col("doc_id").isNotNull())
    else:  # too many for the single task that merges a limit
        kept = add_rank(ids, order).where(F.col("rank") < n).select("doc_id")
    return df.join(kept, "doc_id", "left_semi")


def prefix(df: DataFrame, n_rows: int) -> DataFrame:
    """The first ``n_rows`` rows, and of those the ones with text: blanks use up the budget."""
    return _first(df, [F.col("doc_id")], n_rows).where(F.length("text") > 0)


def sample(df: DataFrame, n_rows: int, seed: int) -> DataFrame:
    """``n_rows`` rows in a seeded random order."""
    return _first(df, [uniform(seed, F.col("doc_id")), F.col("doc_id")], n_rows)


def length_filter(df: DataFrame, cfg: IngestConfig = IngestConfig()) -> DataFrame:
    return df.where(F.size(tx.words(F.col("text"))).between(cfg.min_words, cfg.max_words))


def to_raw(df: DataFrame, keep_stats: bool = False) -> DataFrame:
    """Add the ingest quality class and metadata.

    With ``keep_stats`` the counts behind them stay as working columns, which ``quality.annotate`` uses and drops.
    """
    is_code, is_academic = F.col("domain") == "code", F.col("domain") == "academic"
    counted = quality.with_text_stats(df)
    kept = [name for name in counted.columns if name.startswith("_n_")] if keep_stats else []
    return counted.select(
        "doc_id",
        "text",
        "domain",
        quality.ingest_quality(F.col("domain")).alias("quality"),
        "source",
        F.struct(
            F.col("_n_chars").alias("length"),
            F.col("_n_words").alias("word_count"),
            F.col("source").alias("original_dataset"),
            F.when(is_code, F.col("language")).alias("language"),
            F.when(is_academic, F.col("title")).alias("title"),
        ).alias("metadata"),
        *kept,
    )


def ingest(df: DataFrame, spec: SourceSpec, cfg: IngestConfig = IngestConfig()) -> DataFrame:
    """Prefix, seeded sample, length filter and projection of one scanned source."""
    taken = sample(prefix(df, cfg.prefix_factor * spec.max_documents), spec.max_documents, cfg.seed)
    return to_raw(length_filter(taken, cfg))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def source_report(df: DataFrame, specs: tuple[SourceSpec, ...], cfg: IngestConfig = IngestConfig()) -> DataFrame:
    """Per declared source: its settings, the rows available and the rows the prefix reads."""
    spark = df.sparkSession
    declared = spark.createDataFrame(
        [(s.domain, s.dataset, s.subset, s.split, s.text_column, s.weight, s.max_documents) for s in specs],
        "domain string, dataset string, subset string, split string, text_column string,"
        " weight double, max_documents int",
    )
    available = df.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain")).agg(F.count("*").alias("available"))
    rows = F.coalesce(F.col("available"), F.lit(0))
    # Domains that nobody declared are reported too.
    return declared.join(available, "domain", "full").select(
        *declared.columns,
        rows.alias("available"),
        F.least(rows, F.lit(cfg.prefix_factor) * F.coalesce("max_documents", F.lit(0))).alias("prefix_rows"),
    )


def domain_mix_gap(df: DataFrame, specs: tuple[SourceSpec, ...]) -> DataFrame:
    """(domain, weight, share, gap): what each domain was declared to weigh, and its share of the rows."""
    declared = df.sparkSession.createDataFrame([(s.domain, s.weight) for s in specs], "domain string, weight double")
    counts = stage(df.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain")).agg(F.count("*").alias("_n")), "domain_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 1
    share = F.coalesce(F.col("_n"), F.lit(0)) / F.lit(total)
    return counts.join(declared, "domain", "full").select(
        "domain", F.coalesce("weight", F.lit(0.0)).alias("weight"), share.alias("share")
    ).withColumn("gap", F.col("share") - F.col("weight"))
