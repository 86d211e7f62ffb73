"""Scores and filters on hand-made rows at and around every limit."""

import pytest
from pyspark.sql import functions as F

from loamsift.operators import exact, quality
from loamsift.sources.documents import to_raw


@pytest.fixture
def annotate(spark, raw_of):
    def run(rows):
        raw = raw_of(rows)
        marked = exact.with_hash(raw).withColumn("is_duplicate", F.lit(False))
        return [r for r in quality.annotate(marked).orderBy("doc_id").collect()]

    return run


def checks(row):
    return row["metadata"]["filter_results"]


def varied(n, length=5):
    return " ".join(f"{i:0{length}d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(n))


def test_short_documents(raw_of):
    from loamsift.config import CorpusConfig, DedupConfig
    from loamsift.plans import corpus

    good = "The river rises every spring and floods the lower meadows. Herons come back to nest there."
    raw = raw_of([(good, "web", "high"), ("ferry bicycle marble onion seven lantern", "web", "low"), (good, "web", "high")])
    rows = corpus.process(raw, CorpusConfig(dedup=DedupConfig())).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [0, 1]
    assert [r["quality_class"] for r in rows] == ["low", "low"]
    assert not any(checks(r)["passes"] for r in rows)
    assert [r["metadata"]["original_quality"] for r in rows] == ["high", "low"]
    assert not any(r["is_duplicate"] for r in rows)


def test_empty_text_has_a_reason_and_no_other_check(annotate):
    for row in annotate([("", "web"), (" \n\t", "code")]):
        assert checks(row).asDict() == {**dict.fromkeys(quality.CHECKS), "passes": False, "reason": "empty_text"}
        assert row["metadata"]["perplexity"] == float("inf")
        assert row["quality_score"] == 0 and row["quality_class"] == "low"


def test_limits_are_inclusive(annotate):
    rows = annotate([
        (varied(49), "web"), (varied(50), "web"),
        (varied(60, 3), "web"), (" ".join(["ab"] * 60), "web"),
        (varied(60, 10), "web"), (varied(60, 11), "web"),
        ("!" * 25 + "a" * 75, "web"), ("!" * 26 + "a" * 74, "web"),
        ("1" * 15 + "a" * 85, "web"), ("1" * 16 + "a" * 84, "web"),
        ("http://x " + "word " * 4, "web"), ("http://x " + "word " * 3, "web"),
        ("\n".join(["a"] * 2 + list("bcd")), "web"), ("\n".join(["a"] * 4 + list("bcdefg")), "web"),
    ])
    names = ["length_ok", "word_length_ok", "word_length_ok", "non_alpha_ok", "number_ratio_ok", "url_ratio_ok"]
    want = [(False, True), (True, False), (True, False), (True, False), (True, False), (True, False)]
    for i, (name, pair) in enumerate(zip(names, want)):
        assert (checks(rows[2 * i])[name], checks(rows[2 * i + 1])[name]) == pair, name
    # 1 of 5 lines; then 3 of 10, for which 1 - 7/10 is just above 0.3 in double precision.
    assert checks(rows[12])["duplicate_lines_ok"] and not checks(rows[13])["duplicate_lines_ok"]


def test_code_filters(annotate):
    body = varied(60).split()

    def code(n_lines, n_comments, mark="#"):
        lines = [f"  {mark} note" for _ in range(n_comments)] + [f"line{i} {body[i % 60]}" for i in range(n_lines - n_comments)]
        return "\n\n".join(lines)

    rows = annotate([
        (code(4, 1), "code"), (code(5, 1), "code"), (code(20, 0), "code"), (code(20, 1, "//"), "code"),
        (code(20, 17), "code"), (code(20, 18), "code"), (code(20, 0) + "\nx = 1 /* y */", "code"), (code(20, 0), "web"),
    ])
    got = [(checks(r)["code_length_ok"], checks(r)["code_comment_ok"]) for r in rows]
    assert got == [
        (False, True), (True, True), (True, False), (True, True),
        (True, True), (True, False), (True, True), (None, None),
    ]


def test_classes_follow_perplexity(annotate):
    # 60 words of which few are distinct: the estimate rises as the share of distinct words falls.
    rows = annotate([
        (varied(100), "web"),
        (" ".join((varied(12, 3).split() * 9)[:100]) , "web"),
        (" ".join((varied(5, 3).split() * 20)[:100]), "web"),
    ])
    for r in rows:
        words = r["text"].split()
        ppl = min(1000 / (sum(map(len, words)) / len(words) * len(set(words)) / len(words) + 0.1), 10000)
        assert r["metadata"]["perplexity"] == pytest.approx(ppl)
        assert r["quality_score"] == pytest.approx(max(0, 1 - ppl / 10000))
        want = "high" if ppl <= 1500 else "medium" if ppl <= 3500 else "low"
        assert r["quality_class"] == want
    assert {r["quality_class"] for r in rows} == {"high", "medium", "low"}


def test_toxicity_counts_substrings_once(annotate):
    rows = annotate([("studies of Attack attack", "web"), ("calm", "web"), (" ".join(quality.TOXIC_TERMS), "web")])
    assert [round(r["toxicity_score"], 3) for r in rows] == [0.2, 0.0, 1.0]


def test_ingest_quality(spark, texts_of):
    def grade(text, domain):
        df = texts_of([text]).withColumns({"domain": F.lit(domain), "source": F.lit("s"), "language": F.lit("py"), "title": F.lit("t")})
        row = to_raw(df).first()
        return row["quality"], row["metadata"]["language"], row["metadata"]["title"]

    assert grade("def f(): # note " + "x " * 20, "code") == ("high", "py", None)
    assert grade("return " + "x " * 12, "code") == ("medium", "py", None)
    assert grade("x " * 30, "code") == ("low", "py", None)
    assert grade("Abstract " + varied(120, 6), "academic") == ("high", None, "t")
    assert grade(varied(60, 6), "academic") == ("medium", None, "t")
    assert grade(varied(60, 5), "academic") == ("low", None, "t")
    assert grade(varied(101), "web") == ("high", None, None)
    assert grade(varied(100), "web") == ("medium", None, None)
    assert grade(varied(101).upper(), "web")[0] == "medium"
    assert grade(varied(50), "web")[0] == "low"
