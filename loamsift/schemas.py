"""Explicit schemas of the stage tables."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("length", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("original_dataset", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("title", T.StringType()),
])

RAW = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("quality", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("metadata", METADATA),
])

FILTER_RESULTS = T.StructType(
    [
        T.StructField(name, T.BooleanType())
        for name in (
            "length_ok",
            "word_length_ok",
            "non_alpha_ok",
            "number_ratio_ok",
            "url_ratio_ok",
            "duplicate_lines_ok",
            "code_length_ok",
            "code_comment_ok",
            "passes",
        )
    ]
    + [T.StructField("reason", T.StringType())]
)

PROCESSED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("quality_class", T.StringType()),
    T.StructField("toxicity_score", T.DoubleType()),
    T.StructField("hash_id", T.StringType()),
    T.StructField("is_duplicate", T.BooleanType()),
    T.StructField("metadata", T.StructType(
        METADATA.fields
        + [
            T.StructField("perplexity", T.DoubleType()),
            T.StructField("original_quality", T.StringType()),
            T.StructField("filter_results", FILTER_RESULTS),
        ]
    )),
])
