"""Selection against a small computation in plain Python."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loamsift.config import SelectionConfig
from loamsift.functions.stopwords import ENGLISH
from loamsift.operators import selection, tfidf
from loamsift.operators.ranking import add_rank, top_fraction
from loamsift.schemas import PROCESSED

# Two words that go together ("tide tables", "moon rises"), some alone, two documents of the target class.
TEXTS = [
    ("tide tables moon tide", "high", "books"),
    ("moon rises late tonight", "low", "news"),
    ("tide tables sold nightly", "medium", "web"),
    ("the tide clock: moon rises", "medium", "code"),
    ("moon rises, tide tables, moon rises", "high", "academic"),
]


@pytest.fixture
def processed_of(spark):
    def make(rows):
        data = [
            (i, text, domain, 0.5, quality, 0.1, f"h{i}", False, None)
            for i, (text, quality, domain) in enumerate(rows)
        ]
        return spark.createDataFrame(data, PROCESSED)

    return make


def terms(text):
    words = [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in ENGLISH]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def scores(targets, docs, max_features=10_000):
    """Importance scores with dense dictionaries."""
    counted = [Counter(terms(t)) for t in targets]
    df = Counter(t for c in counted for t in c)
    total = sum(counted, Counter())
    n = len(targets)
    vocab = [t for t in df if 2 <= df[t] <= 0.95 * n]
    vocab = sorted(vocab, key=lambda t: (-total[t], t))[:max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}

    def vector(text):
        v = {t: c * idf[t] for t, c in Counter(terms(text)).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def mean(texts, eps):
        m = {t: sum(vector(x).get(t, 0) for x in texts) / len(texts) for t in vocab}
        s = sum(m.values()) + eps
        return {t: x / s for t, x in m.items()}

    p, q = mean(targets, 0), mean(docs, 1e-10)
    w = {t: min(10, max(0.1, p[t] / (q[t] + 1e-10))) for t in vocab}
    return [round(sum(x * w[t] for t, x in vector(d).items()), 6) for d in docs], vocab


def test_few_targets_take_in_medium(processed_of):
    target = selection.target_docs(processed_of(TEXTS))
    assert sorted(r["doc_id"] for r in target.collect()) == [0, 2, 3, 4]
    assert not selection.enough_targets(target)
    assert selection.hybrid_select(processed_of(TEXTS)).count() == 5  # too few targets: all pass


def test_medium_target_counts_itself_twice(processed_of):
    cfg = SelectionConfig(target_class="medium")
    assert selection.target_docs(processed_of(TEXTS), cfg).count() == 4


@pytest.mark.parametrize("max_features", [10_000, 12])
def test_scores_match_plain_python(processed_of, max_features):
    rows = TEXTS * 3 + [("unrelated zebra words entirely", "low", "news"), ("", "low", "code")]
    processed = processed_of(rows)
    cfg = SelectionConfig(max_features=max_features)
    targets = [t for t, q, _ in rows if q == "high"] + [t for t, q, _ in rows if q == "medium"]
    want, vocab = scores(targets, [r[0] for r in rows], max_features)
    fitted = selection.fit_importance(selection.target_docs(processed), cfg)
    assert {r["term"] for r in fitted.vocabulary.collect()} == set(vocab)
    got = {r["doc_id"]: r["dsir"] for r in selection.importance_scores(processed, fitted).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(want, abs=2e-6)
    assert got[len(rows) - 1] == 0
    total = fitted.target.agg(F.sum("p")).first()[0]
    assert total == pytest.approx(1)


def test_hybrid_keeps_the_floor_of_the_rate_in_dense_ranks(processed_of):
    rows = TEXTS * 6
    selected = selection.hybrid_select(processed_of(rows)).orderBy("selection_rank").collect()
    assert [r["selection_rank"] for r in selected] == list(range(int(len(rows) * 0.95)))
    order = [(-r["selection_score"], r["doc_id"]) for r in selected]
    assert order == sorted(order)
    assert {r["selected_by"] for r in selected} == {"hybrid"}


def test_attribute_scores(processed_of):
    rows = [("a", "high", "web"), ("b", "low", "academic"), ("c", "odd", "odd")]
    df = processed_of(rows)
    score = selection.attribute_score(F.col("quality_class"), F.col("domain"))
    full = selection.attribute_score(F.col("quality_class"), F.col("domain"), include_scores=True)
    got = df.select(F.round(score, 6), F.round(full, 6)).collect()
    assert [tuple(r) for r in got] == [(2.0, 3.4), (0.7, 2.1), (1.0, 2.4)]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_rank_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") * 7 % 50).alias("s"),
                                 F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ranked = add_rank(df.repartition(7), [F.col("s").desc(), F.col("doc_id")]).collect()
        grouped = add_rank(df.repartition(7), [F.col("s").desc(), F.col("doc_id")], within="g").collect()
        top = top_fraction(df, "s", 0.3, within="g").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want = sorted(ranked, key=lambda r: (-r["s"], r["doc_id"]))
    assert [r["rank"] for r in want] == list(range(500))
    for g in {r["g"] for r in grouped}:
        of_g = sorted((r for r in grouped if r["g"] == g), key=lambda r: (-r["s"], r["doc_id"]))
        assert [r["rank"] for r in of_g] == list(range(len(of_g)))
        assert sum(r["g"] == g for r in top) == int(len(of_g) * 0.3)


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vectors_and_counts_take_no_exchange(spark, texts_of):
    docs = texts_of([text for text, *_ in TEXTS])
    vocabulary, _ = tfidf.fit_vocabulary(docs)
    for df in (tfidf.term_counts(docs), tfidf.vectors(docs, vocabulary)):
        assert not re.search("Exchange|Aggregate|Sort|Window", _plan_of(df))


def test_rows_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame(
        [(1, "tide tables moon"), (1, "moon rises tide"), (2, "moon tide tide"), (None, "tide moon"), (None, "moon"), (3, None), (4, "")],
        "doc_id bigint, text string",
    )
    counted = {}
    for doc_id, text in docs.collect():
        counted.setdefault(doc_id, Counter()).update(terms(text or ""))
    assert {(r["doc_id"], r["term"]): r["tf"] for r in tfidf.term_counts(docs).collect()} == {
        (doc_id, term): tf for doc_id, c in counted.items() for term, tf in c.items()
    }
    vocabulary = spark.createDataFrame([("tide", 1.0), ("moon", 2.0), ("moon rises", 3.0)], "term string, idf double")
    idf = dict(vocabulary.collect())
    for cfg in (SelectionConfig(), SelectionConfig(max_features=tfidf.BROADCAST_MAX_TERMS + 1)):
        got = {(r["doc_id"], r["term"]): (r["tf"], round(r["tfidf"], 9)) for r in tfidf.vectors(docs, vocabulary, cfg).collect()}
        expected = {}
        for doc_id, c in counted.items():
            weight = {t: tf * idf[t] for t, tf in c.items() if t in idf}
            norm = math.sqrt(sum(w * w for w in weight.values()))
            expected.update({(doc_id, t): (c[t], round(w / norm, 9)) for t, w in weight.items()})
        assert got == expected
