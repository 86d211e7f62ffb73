"""Exact and near duplicates against going through the documents one by one."""

import random

import pytest
from pyspark.sql import functions as F

from loamsift.config import DedupConfig
from loamsift.operators import exact, fuzzy, keyed_join, staging
from loamsift.operators.keyed_join import spread_join


def grams(text):
    words = text.lower().split()
    if not words:
        return set()
    if len(words) < 3:
        return {" ".join(words)}
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def one_by_one(texts, t, similarity=None):
    sets, kept, out = [grams(x) for x in texts], [], {}
    for i in range(len(texts)):
        for j in kept:
            s = jaccard(sets[i], sets[j])
            if s >= t - 1e-12 and similarity:
                s = similarity(texts[i], texts[j])
                hit = s >= 0.85
            else:
                hit = s >= t - 1e-12 and similarity is None
            if hit:
                out[i] = (j, round(s, 9))
                break
        else:
            kept.append(i)
    return out


def found(spark, texts, cfg=DedupConfig(), **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (r["kept_id"], round(r["similarity"], 9)) for r in fuzzy.fuzzy_matches(df, cfg, **kw).collect()}


def corpus(seed, n=80, templates=6, length=40, hot=0):
    """Near copies of a few texts, texts that share a long passage, and unrelated ones."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocab) for _ in range(length)] for _ in range(templates)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if i < hot:
            words = list(bases[0])
            for _ in range(rng.randrange(1, 3)):
                words[rng.randrange(length)] = f"u{i}_{rng.randrange(9)}"
        elif kind < 0.5:
            words = list(rng.choice(bases))
            for _ in range(rng.randrange(0, 8)):
                words[rng.randrange(length)] = rng.choice(vocab)
            words = words[: rng.randrange(length // 2, length + 1)]
        elif kind < 0.7:
            words = bases[1][: int(length * 0.7)] + [f"v{i}_{k}" for k in range(int(length * 0.3))]
        elif kind < 0.8:
            words = [rng.choice(vocab) for _ in range(rng.randrange(0, 4))]
        else:
            words = [rng.choice(vocab) for _ in range(length)]
        texts.append(" ".join(words))
    rng.shuffle(texts)
    return list(dict.fromkeys(texts))


@pytest.mark.parametrize("seed,leaders,t", [(1, 4, 0.6), (2, 1, 0.6), (3, 1, 0.3)])
def test_same_as_one_by_one(spark, seed, leaders, t):
    texts = corpus(seed)
    want = one_by_one(texts, t)
    assert len(want) > 5
    assert found(spark, texts, DedupConfig(jaccard_threshold=t), first_leaders=leaders) == want


def test_a_third_of_the_corpus_is_one_group_of_copies(spark, monkeypatch):
    """With a low limit on rows per task, so that every join splits its hot keys."""
    monkeypatch.setattr(keyed_join, "MIN_ROWS_PER_TASK", 10)
    texts = corpus(4, n=150, hot=50)
    assert found(spark, texts) == one_by_one(texts, 0.6)


def test_unlike_documents_in_one_bucket(spark):
    """Documents that share two thirds of their grams but no pair reaches the threshold."""
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join(shared + [f"x{d}_{i}" for i in range(18)]) for d in range(30)]
    assert one_by_one(texts, 0.6) == {}
    assert found(spark, texts, first_leaders=1) == {}


def test_chain_keeps_both_ends(spark):
    a = [f"a{i}" for i in range(40)]
    b = a[:36] + [f"b{i}" for i in range(4)]
    c = b[6:] + [f"c{i}" for i in range(6)]
    texts = [" ".join(x) for x in (a, b, c)]
    ga, gb, gc = map(grams, texts)
    assert jaccard(ga, gb) >= 0.6 and jaccard(gb, gc) >= 0.6 > jaccard(ga, gc)
    assert set(found(spark, texts)) == {1}


def test_partition_count_does_not_matter(spark):
    texts = corpus(6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    results = []
    for n in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, fuzzy.fuzzy_matches(df.repartition(n)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert fuzzy.fuzzy_matches(df).count() == 0
    assert exact.exact_dedup(df).count() == 0


def test_flags_name_the_hash_of_the_kept_one(spark, texts_of):
    base = " ".join(f"w{i}" for i in range(50))
    rows = {r["doc_id"]: r for r in fuzzy.fuzzy_flags(texts_of([base, "other text here", base + " more"])).collect()}
    assert [rows[i]["is_duplicate"] for i in range(3)] == [False, False, True]
    assert rows[2]["similar_to"] == rows[0]["hash_id"] and rows[0]["similar_to"] is None


TEXTS = ["a", "b", "a", "", "c", "a", "", "b"]


def test_exact(spark, texts_of):
    df = texts_of(TEXTS)
    kept = sorted(r["doc_id"] for r in exact.exact_dedup(df).collect())
    assert kept == [0, 1, 3, 4]
    again = exact.exact_dedup(exact.exact_dedup(df).drop("hash_id", "is_duplicate"))
    assert sorted(r["doc_id"] for r in again.collect()) == kept
    flags = {r["doc_id"]: r["is_duplicate"] for r in exact.exact_dup_flags(df).collect()}
    assert [i for i in flags if flags[i]] and sorted(i for i in flags if not flags[i]) == kept
    audit = sorted((r["doc_id"], r["first_doc_id"]) for r in exact.exact_dup_audit(df).collect())
    assert audit == [(2, 0), (5, 0), (6, 3), (7, 1)]


def test_incremental_equals_one_run(spark, texts_of):
    df = texts_of(TEXTS)
    first = exact.exact_dedup_incremental(df.where("doc_id < 3"), None)
    second = exact.exact_dedup_incremental(df.where("doc_id >= 3"), first)
    assert sorted(r["doc_id"] for r in first.union(second).collect()) == [0, 1, 3, 4]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_join(spark, how):
    many = spark.range(2000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    one = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(map(tuple, many.join(one, "k", how).select("row", "k", "v").collect()))
    got = spread_join(many, one, "k", "row", how, min_rows=20)
    assert sorted(map(tuple, got.select("row", "k", "v").collect())) == want
    assert "_salt" in got._jdf.queryExecution().toString()


def test_exact_dedup_leaves_texts_where_they_are(spark, texts_of):
    kept = exact.exact_dedup(texts_of(["a b", "c", "a b", None, "", None]))
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(0, "a b"), (1, "c"), (3, None), (4, "")]


def test_exact_dedup_of_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, "b"), (None, "c"), (4, "d"), (4, "e")]
    kept = exact.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a"), (1, "a"), (3, "b")] + 2 * [(4, "d")] + 2 * [(4, "e")]
    alone = exact.exact_dedup(spark.createDataFrame(rows[2:6], "doc_id bigint, text string"))
    assert [(r["doc_id"], r["text"]) for r in alone.orderBy("doc_id").collect()] == [(2, "a"), (3, "b")]


def test_shared_grams_move_once(spark, monkeypatch):
    docs = staging.stage(spark.createDataFrame([(1, [5, 6, 7]), (2, [6, 7]), (3, [7, 8]), (4, [9]), (5, [])], "doc_id bigint, grams array<bigint>"), "grams")
    shared = fuzzy.shared_grams(docs)
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert {r["doc_id"]: r["shared"] for r in shared.collect()} == {1: [6, 7], 2: [6, 7], 3: [7]}
    monkeypatch.setattr(fuzzy, "ONE_GRAM_ROWS", 0)
    assert {r["doc_id"]: r["shared"] for r in fuzzy.shared_grams(docs).collect()} == {1: [6, 7], 2: [6, 7], 3: [7]}


def test_near_duplicates_write_shingles_only_where_ids_repeat(spark, monkeypatch):
    from loamsift.operators import fuzzy, staging

    names = []
    monkeypatch.setattr(fuzzy, "stage", lambda df, name: names.append(name) or staging.stage(df, name))
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (2, "other words that nobody else has here"), (3, text + " eleven"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [(r.doc_id, r.kept_id) for r in fuzzy.fuzzy_matches(docs).collect()] == [(3, 1)]
    assert "shingle_sets" in names and "shingles" not in names
    twice = docs.union(docs.where("doc_id = 3"))
    assert [(r.doc_id, r.kept_id) for r in fuzzy.fuzzy_matches(twice).collect()] == [(3, 1)]
    assert "shingles" in names


def test_a_round_moves_its_keys_once(spark, monkeypatch):
    plans = []

    def staged(df, name):
        if name == "buckets":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staging.stage(df, name)

    monkeypatch.setattr(fuzzy, "stage", staged)
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text), (2, "other words here"), (3, text + " eleven")], "doc_id bigint, text string")
    assert [(r.doc_id, r.kept_id) for r in fuzzy.fuzzy_matches(docs).collect()] == [(3, 1)]
    assert plans and all("ReusedExchange" in plan for plan in plans)
