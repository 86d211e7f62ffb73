"""Batches against going through the groups one document at a time."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamsift.config import SamplingConfig, SequenceConfig
from loamsift.operators import prep, sampling

DEMO = [("web", "high"), ("web", "medium"), ("code", "high"), ("code", "low"), ("books", "high")]


@pytest.fixture
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, d, q) for i, (d, q) in enumerate(rows)], "doc_id bigint, domain string, quality string"
        )

    return make


def u(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16**13


def round_robin(domains, size, batches, epochs, seed=42):
    """Take turns until a group has nothing left for its turn."""
    order, used, out = list(dict.fromkeys(domains)), Counter(), []
    lists = {
        d: [i for e in range(epochs) for i in sorted((i for i, x in enumerate(domains) if x == d), key=lambda i: (u(seed, e, i), i))]
        for d in order
    }
    for b in range(batches):
        batch = []
        for _ in range(size):
            d = order[len(batch) % len(order)]
            if used[d] < len(lists[d]):
                batch.append(lists[d][used[d]])
                used[d] += 1
        out += [(b, p, i) for p, i in enumerate(batch)]
    return out


def test_demo_batch_stops_at_the_smallest_group(docs_of):
    batch = sampling.draw_batch(docs_of(DEMO), 10, SamplingConfig(method="unimax"), domain="english").collect()
    assert sorted(r["position"] for r in batch) == [0, 1, 2, 3, 4]
    assert Counter(r["domain"] for r in batch) == {"web": 2, "code": 2, "books": 1}


def test_round_robin_goes_on_from_a_written_state(spark, docs_of, tmp_path):
    domains = ["a"] * 12 + ["b"] * 5 + ["c"] * 3 + ["a"] * 6 + [None] * 4
    docs, cfg, state, got = docs_of([(d, "x") for d in domains]), SamplingConfig(max_epochs=2), None, []
    for number, batches in enumerate((1, 2, 1, 9)):
        rows, state = sampling.unimax_run(docs, 7, batches, cfg, state=state)
        got += [(r["batch_id"], r["position"], r["doc_id"]) for r in rows.collect()]
        state.write.parquet(str(tmp_path / str(number)))  # as another session would read it
        state = spark.read.parquet(str(tmp_path / str(number)))
    assert sorted(got) == round_robin([d or "unknown" for d in domains], 7, 13, 2)


def test_ten_thousand_groups_have_a_small_plan(spark):
    """Groups of unequal sizes run short one by one; the plan doesn't grow with them."""
    n = 10_000
    docs = spark.range(n * 4).select(F.col("id").alias("doc_id"), (F.col("id") % n).cast("string").alias("domain"))
    docs = docs.where(F.expr("doc_id < 30000 OR xxhash64(doc_id) % 3 = 0"))
    begin = time.time()
    rows, state = sampling.unimax_run(docs, 5000, 8)
    plan = rows._jdf.queryExecution().toString()
    assert time.time() - begin < 60 and len(plan) < 100_000
    got = rows.groupBy("batch_id").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).orderBy("batch_id").collect()
    # Every batch begins with the first group: three are full, then it is soon the turn of a group without a fourth document.
    assert [r["n"] for r in got[:3]] == [5000] * 3 and len(got) < 8 and all(r["n"] == r["d"] for r in got)
    assert state.agg(F.sum("taken")).first()[0] == sum(r["n"] for r in got)


@pytest.mark.parametrize("size,batches,epochs", [(7, 5, 1), (3, 9, 2), (100, 2, 3), (1, 4, 1)])
def test_round_robin(docs_of, size, batches, epochs):
    domains = ["a"] * 12 + ["b"] * 5 + ["c"] * 2 + ["a"] * 6 + [None]
    rows = sampling.unimax_batches(docs_of([(d, "x") for d in domains]), size, batches, SamplingConfig(max_epochs=epochs)).collect()
    got = sorted((r["batch_id"], r["position"], r["doc_id"]) for r in rows)
    assert got == round_robin([d or "unknown" for d in domains], size, batches, epochs)


def test_weights(docs_of):
    stats = sampling.group_statistics(docs_of(DEMO))

    def weights(df, by="domain"):
        return {r[by]: round(r["weight"], 6) for r in df.collect()}

    assert weights(sampling.unimax_weights(stats)) == dict.fromkeys(("web", "code", "books"), 0.333333)
    total = 2 * 0.4**1.3 + 0.2**1.3
    assert weights(sampling.alpha_weights(stats)) == {
        "web": round(0.4**1.3 / total, 6), "code": round(0.4**1.3 / total, 6), "books": round(0.2**1.3 / total, 6)
    }
    assert weights(sampling.preference_weights(stats, {"web": 3, "code": 1})) == {"web": 0.75, "code": 0.25, "books": 0.1}
    fine = sampling.group_statistics(sampling.with_buckets(docs_of(DEMO)), "bucket")
    assert weights(sampling.bucket_weights(fine), "bucket") == {
        "web_high": round(2 / 7.5, 6), "web_medium": round(1 / 7.5, 6), "code_high": round(2 / 7.5, 6),
        "code_low": round(0.5 / 7.5, 6), "books_high": round(2 / 7.5, 6),
    }


def test_draws_follow_the_masses(docs_of):
    docs = docs_of([("a", "high")] * 600 + [("b", "low")] * 400)
    batch = sampling.alpha_batch(docs, 5000)
    assert batch.count() == 1000  # never more draws than documents
    share = batch.where("domain = 'a'").count() / 1000
    observed = 0.6**2.3 / (0.6**2.3 + 0.4**2.3)
    assert share == pytest.approx(observed, abs=0.05)
    again = sampling.alpha_batch(docs.repartition(5), 5000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, batch.collect()))
    documented = sampling.alpha_batch(docs, 5000, documented=True).where("domain = 'a'").count() / 1000
    assert documented == pytest.approx(0.6**1.3 / (0.6**1.3 + 0.4**1.3), abs=0.05)
    drawn = sampling.attribute_batch(docs, 3000)
    assert drawn.count() == 3000
    assert drawn.where("bucket = 'a_high'").count() / 3000 == pytest.approx(1.2 / 1.4, abs=0.03)


def test_method_choice(docs_of):
    assert sampling.method_for("alpha", "english") == "unimax"
    assert sampling.method_for("preference", "code") == "alpha"
    assert [sampling.method_for(m) for m in ("unimax", "alpha", "preference", "attribute", "other")] == [
        "unimax", "alpha", "preference", "attribute", "unimax"
    ]
    assert sampling.method_by_composition(docs_of(DEMO)).first()["method"] == "alpha"
    assert sampling.method_by_composition(docs_of(DEMO[:3] + DEMO[:1])).first()["method"] == "unimax"
    weighted = sampling.with_sampling_weight(docs_of(DEMO))
    assert weighted.count() == 5 and weighted.where("sampling_method = 'alpha'").count() == 5


def test_many_groups(spark):
    n = sampling.FEW_GROUPS + 1
    df = spark.range(2 * n).select(F.col("id").alias("doc_id"), (F.col("id") % n).cast("string").alias("domain"))
    batch = sampling.unimax_batch(df, n + 5).collect()
    assert len(batch) == n + 5 and [r["domain"] for r in sorted(batch, key=lambda r: r["position"])][:3] == ["0", "1", "2"]
    assert sampling.alpha_batch(df, 500).count() == 500
    weighted = sampling.with_sampling_weight(df)
    assert weighted.count() == 2 * n and weighted.where("sampling_weight > 0").count() == 2 * n


def test_many_batches_are_few_stretches():
    counts = np.array([4_000_000, 2_500_000, 9_000_000])
    found = sampling._stretches(counts, 6, 10**6)
    assert found == [(0, 10**6, 6)]
    short = sampling._stretches(np.array([10, 3, 7]), 5, 50)
    assert sum(k for _, k, _ in short) <= 50 and len(short) <= 12


@pytest.mark.parametrize("method", ["unimax", "alpha", "preference", "attribute"])
def test_every_method_draws(docs_of, method):
    docs = docs_of([("a", "high")] * 30 + [("b", "low")] * 20)
    batch = sampling.draw_batch(docs, 10, SamplingConfig(method=method), preferences={"a": 1.0})
    assert batch.count() == 10


def test_sequences(texts_of):
    df = texts_of(["", "ab", "Abcdefgh"])
    rows = prep.training_sequences(df, SequenceConfig(max_length=6)).orderBy("doc_id").collect()
    full = [[1, 2, 0, 0, 0, 0], [1, 197, 198, 2, 0, 0], [1, 197, 198, 199, 200, 201]]
    for row, tokens in zip(rows, full):
        assert row["input_ids"] == tokens[:-1] and row["labels"] == tokens[1:]
        assert row["attention_mask"] == [True] * 5
    assert [r["n_tokens"] for r in rows] == [2, 4, 10]


def test_split_and_batches(spark):
    ids = spark.range(103).select(F.col("id").alias("doc_id"))
    selected = ids.withColumn("selection_rank", F.lit(102) - F.col("doc_id"))
    train = [r["doc_id"] for r in prep.train_eval_split(selected).where("split = 'train'").collect()]
    assert sorted(train) == list(range(103 - int(103 * 0.8), 103))
    batches = prep.epoch_batches(ids, epoch=3).collect()
    assert sorted(r["doc_id"] for r in batches) == list(range(103))
    sizes = Counter(r["batch_id"] for r in batches)
    assert [sizes[b] for b in sorted(sizes)] == [8] * 12 + [7]
    order = sorted(range(103), key=lambda i: (u(42, 3, i), i))
    assert [r["doc_id"] for r in sorted(batches, key=lambda r: (r["batch_id"], r["place"]))] == order
    plain = prep.epoch_batches(ids, shuffle=False).collect()
    assert all(r["batch_id"] == r["doc_id"] // 8 and r["place"] == r["doc_id"] % 8 for r in plain)


def test_an_index_gives_the_same_draws_in_any_batches(docs_of, monkeypatch):
    monkeypatch.setattr(sampling, "MEMBERS", 8)
    docs = docs_of([("a", "x")] * 40 + [("b", "x")] * 25 + [(None, "x")] * 5)
    whole = {r["draw"]: (r["doc_id"], r["domain"]) for r in sampling.alpha_batch(docs, 60).collect()}
    index = sampling.alpha_index(docs)
    parts = [index.draws(0, 20), index.draws(20, 1), index.draws(21, 39)]
    assert {r["draw"]: (r["doc_id"], r["domain"]) for part in parts for r in part.collect()} == whole
    plan = parts[2]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange rangepartitioning" not in plan and "PartitionFilters" in plan
    assert index.draws(0, 0).count() == 0
