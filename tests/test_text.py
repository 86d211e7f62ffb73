"""Text expressions against plain Python, on the characters that regex engines differ in."""

import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loamsift.functions import stopwords
from loamsift.functions import text as tx
from loamsift.functions.seeded import uniform
from loamsift.operators.fuzzy import ngram_signature, with_tokens
from loamsift.operators.prep import encode

EDGE = [
    "", " ", "\n\n", "one", "two words", "a b c d", " wide　space x\x1cy\x85z", "x² ①5 ٣ ½ Ⅷ",
    "Ünïcode ÇA é 😀 emoji", "UPPER Ⅷ Ⓐ lower", "see http://a.b/c and https://d e", "a\r\nb\x0bc\tc",
    "tail\n", "\nhead", "!!!", "_under_ score_2",
]
ALPHABET = st.characters(codec="utf-8", exclude_categories=("Cs", "Cn", "Co"))


def ngrams(text, n=3):
    words = text.lower().split()
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def codes(text):
    body = [ord(c) % 31900 + 100 if c.isalnum() else 50 if c.isspace() else 51 for c in text.lower()]
    return [1, *body, 2]


def check(spark, texts):
    df = with_tokens(spark.createDataFrame([(t,) for t in texts], "text string"))
    t = F.col("text")
    rows = df.select(
        "text", tx.words(t).alias("words"), tx.lines(t).alias("lines"), tx.symbol_chars(t).alias("symbols"),
        tx.digit_chars(t).alias("digits"), tx.uppercase_chars(t).alias("upper"), tx.url_count(t).alias("urls"),
        tx.total_length(tx.words(t)).alias("chars"), ngram_signature(F.col("_tokens")).alias("grams"),
        encode(t).alias("codes"), tx.content_hash(t, "sha256").alias("sha"),
    ).collect()
    import re

    for r in rows:
        text = r["text"]
        assert r["words"] == text.split(), repr(text)
        assert r["lines"] == text.split("\n"), repr(text)
        assert r["symbols"] == sum(not c.isalnum() and not c.isspace() for c in text), repr(text)
        assert r["digits"] == sum(c.isdigit() for c in text), repr(text)
        assert r["upper"] == sum(c.isupper() for c in text), repr(text)
        assert r["urls"] == len(re.findall(r"http[s]?://\S+", text)), repr(text)
        assert r["chars"] == sum(map(len, text.split()))
        assert set(r["grams"]) == ngrams(text) and len(r["grams"]) == len(set(r["grams"]))
        assert r["codes"] == codes(text), repr(text)
        assert r["sha"] == hashlib.sha256(text.encode()).hexdigest()


def test_edge_texts(spark):
    check(spark, EDGE)


def known_to_java(text):
    """Characters newer than the JVM's Unicode tables, or lowercased to several, are left out."""
    import unicodedata

    return all(ord(c) < 0x10000 and len(c.lower()) == 1 and c not in "Σ" and unicodedata.category(c) != "Cn" for c in text)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x24F), max_size=60).filter(known_to_java), min_size=20, max_size=60))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_uniform_is_fixed_by_seed_and_row(spark):
    df = spark.range(1000)
    one = df.select("id", uniform(42, F.col("id")).alias("u")).orderBy("id").collect()
    two = df.repartition(7).select("id", uniform(42, F.col("id")).alias("u")).orderBy("id").collect()
    assert one == two
    assert all(0 <= r["u"] < 1 for r in one)
    assert 0.45 < sum(r["u"] for r in one) / 1000 < 0.55
    want = int(hashlib.md5(b"42:7").hexdigest()[:13], 16) / 16**13
    assert one[7]["u"] == want


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(stopwords.ENGLISH) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_unknown_hash_is_refused():
    import pytest

    with pytest.raises(ValueError):
        tx.content_hash(F.lit("x"), "crc")
