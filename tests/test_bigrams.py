"""The trained bigram model against plain Python and a unigram model."""

import math
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loamsift.operators import bigrams, keyed_join
from loamsift.sources import tables

D = 0.75
TEXTS = ["a b a c", "b a b a", "A  b d", "", None, "c c c c c", "d a b"]


def tokens(text):
    return [*(text or "").lower().split(), " >"]


class Plain:
    def __init__(self, texts):
        self.pairs = Counter(p for t in texts for p in zip([" <", *tokens(t)], tokens(t)))
        self.total, self.next, self.before = Counter(), Counter(), Counter()
        for (v, w), n in self.pairs.items():
            self.total[v] += n
            self.next[v] += 1
            self.before[w] += 1
        self.spare = D * len(self.before) / len(self.pairs) / (len(self.before) + 1)

    def p(self, v, w):
        chance = max(self.before[w] - D, 0) / len(self.pairs) + self.spare
        if not self.total[v]:
            return chance
        return max(self.pairs[v, w] - D, 0) / self.total[v] + D * self.next[v] / self.total[v] * chance


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("rows_per_task", [200_000, 2])
def test_scores_equal_plain_python(spark, monkeypatch, rows_per_task):
    monkeypatch.setattr(keyed_join, "MIN_ROWS_PER_TASK", rows_per_task)  # so that frequent keys are split
    scored = ["a b", "z a q", "", None, "c " * 3000 + "b", "d d A b"]
    model, plain = bigrams.fit(frame(spark, TEXTS)), Plain(TEXTS)
    rows = {r.doc_id: r for r in bigrams.perplexity(frame(spark, scored), model).collect()}
    assert sorted(rows) == list(range(len(scored)))
    for i, text in enumerate(scored):
        own = tokens(text)
        pairs = list(zip([" <", *own], own))
        assert rows[i].n_tokens == len(own) and rows[i].n_known == sum(plain.pairs[p] > 0 for p in pairs)
        assert rows[i].log10_perplexity == pytest.approx(-sum(math.log10(plain.p(*p)) for p in pairs) / len(own), rel=1e-9)


def test_probabilities_of_a_context_add_up_to_one(spark):
    plain = Plain(TEXTS)
    vocabulary = [*plain.before, "never seen"]
    for context in (*plain.total, "never seen"):
        assert sum(plain.p(context, w) for w in vocabulary) == pytest.approx(1)
    model = bigrams.fit(frame(spark, TEXTS))
    pairs = spark.createDataFrame([(v, w) for v in (" <", "a", "never seen") for w in vocabulary], "v string, w string")
    hashed = pairs.select("v", F.xxhash64("v").alias("before"), F.xxhash64("w").alias("word"))
    sums = bigrams.pair_probabilities(hashed, model).groupBy("v").agg(F.sum("p").alias("p")).collect()
    assert [r.p for r in sums] == pytest.approx([1, 1, 1])


def test_held_out_perplexity_is_below_the_unigrams(spark):
    docs = tables.documents(spark, SMALL).select("doc_id", "text").cache()
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scores = bigrams.perplexity(docs.where(held), bigrams.fit(docs.where(~held))).collect()
    count = Counter(w for r in docs.where(~held).collect() for w in tokens(r.text))
    n, kinds, unigram = sum(count.values()), len(count), 0.0
    for r in docs.where(held).collect():
        unigram += sum(-math.log10((count[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in tokens(r.text))
    total = sum(r.n_tokens for r in scores)
    assert sum(r.log10_perplexity * r.n_tokens for r in scores) / total < unigram / total - 0.05


def test_no_training_documents_and_filter(spark):
    model = bigrams.fit(frame(spark, []))
    scores = bigrams.perplexity(frame(spark, ["x y", None]), model).collect()
    assert [r.log10_perplexity for r in scores] == [0.0, 0.0] and all(r.n_known == 0 for r in scores)
    docs = frame(spark, TEXTS)
    scores = bigrams.perplexity(docs, bigrams.fit(docs))
    values = sorted(10**r.log10_perplexity for r in scores.collect())
    kept = bigrams.perplexity_filter(docs, scores, (values[2] + values[3]) / 2)
    assert kept.count() == 3 and kept.columns == docs.columns


def test_pairs_are_counted_once_and_never_written_by_document(spark, monkeypatch):
    from loamsift.operators import staging

    written = {}
    monkeypatch.setattr(bigrams, "stage", lambda df, name: written.setdefault(name, staging.stage(df, name)))
    monkeypatch.setattr(bigrams, "FREQUENT", 6)  # so that some words are frequent and some are not
    docs = frame(spark, TEXTS).withColumn("good", F.col("doc_id") % 2 == 0)
    counts = bigrams.pair_counts(docs, F.col("good"))
    model, plain = bigrams.fit_counts(counts), Plain(TEXTS[::2])
    rows = {r.doc_id: r for r in bigrams.perplexity(docs, model, counts).collect()}
    assert set(written) == {"bigram_counts", "bigram_contexts", "bigram_words", "scored_contexts", "scored_words"}
    assert not any("doc_id" in df.columns for df in written.values())
    for i, text in enumerate(TEXTS):
        own = tokens(text)
        pairs = list(zip([" <", *own], own))
        assert rows[i].n_tokens == len(own) and rows[i].n_known == sum(plain.pairs[p] > 0 for p in pairs)
        assert rows[i].log10_perplexity == pytest.approx(-sum(math.log10(plain.p(*p)) for p in pairs) / len(own), rel=1e-9)
