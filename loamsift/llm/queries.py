"""One query per operator, over its whole table, with the digest columns that are compared."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamsift.llm import class_lm, dialogue, exact_dedup, lexical, licenses, line_dedup, minhash, mixing, packing, quality, sharding, suffix_array, wavelet
from loamsift.llm.common import text_of, without_space
from loamsift.operators.staging import stage

SHARDS = 24


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(documents(spark, folder))
    best = F.array_max(F.transform("matches", lambda m: F.struct(m["dice"], -m["piece"], -m["template"], m["license"])))
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"), best["license"].alias("license"), best["dice"].alias("dice"),
        F.array_distinct(F.transform("matches", lambda m: m["license"])).alias("_all"),
    ).select("doc_id", "n_matches", "license", "dice", F.array_join(F.array_sort("_all"), ",").alias("licenses"))


def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = stage(mixing.sized_documents(documents(spark, folder)), "op2_sized")
    targets = stage(mixing.source_targets(sized), "op2_targets")
    rows = mixing.with_targets(sized, targets)
    return rows.select("doc_id", "size", "source_size", "target", (mixing.copies() * F.col("size")).alias("taken"))


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder)).drop("_text_hash")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(without_space(text_of()), 256)}
    return exact_dedup.exact_groups(documents(spark, folder), digest).drop("level")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality.score(docs, model)


def op6_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    blocks = class_lm.tokenised(documents(spark, folder), held_out)
    words = class_lm.vocabulary(blocks)
    return class_lm.score(blocks, words, class_lm.fit(blocks, words))


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    sized = stage(sharding.sized_documents(documents(spark, folder)), "op7_sized")
    placed = sharding.assign_shards(sized, SHARDS)
    law = [F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    return placed.select("doc_id", "size", "text_crc32", *law)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    cut = line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_pack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenise(documents(spark, folder))
    digest = pieces.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", F.crc32("ids").cast("bigint").alias("ids_crc32"))
    return packing.pack(packing.numbered(digest, "op9_pieces")).drop("_piece")


def op10_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    spans = suffix_array.repeated_spans(documents(spark, folder))
    return spans.select("doc_id", "start_word", "end_word")


def op11_dialogues(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    told = dialogue.report(dialogue.damaged(rows)).withColumnRenamed("conv_id", "_own")
    found = rows.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("_own")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def op12_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.documents(wavelet.written(documents(spark, folder)))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank_documents(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_mix": op2_mix,
    "op3_near_dedup": op3_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_class_lm": op6_class_lm,
    "op7_shards": op7_shards,
    "op8_line_dedup": op8_line_dedup,
    "op9_pack": op9_pack,
    "op10_suffix_array": op10_suffix_array,
    "op11_dialogues": op11_dialogues,
    "op12_wavelet": op12_wavelet,
    "op13_search": op13_search,
}
