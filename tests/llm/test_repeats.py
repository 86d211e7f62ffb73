"""Repeated passages against a brute-force search, where neighbours alone or partition borders could hide some."""

import collections
import random

from loamsift.llm import suffix_array


def brute_force(texts):
    """All windows of 50 words that two documents hold, merged where they overlap or touch."""
    words, holders = {k: t.split() for k, t in texts.items()}, collections.defaultdict(set)
    windows = {k: [tuple(w[i : i + 50]) for i in range(len(w) - 49)] for k, w in words.items()}
    for k, own in windows.items():
        for window in own:
            holders[window].add(k)
    spans = set()
    for k, own in windows.items():
        now = None
        for i, window in enumerate(own):
            if len(holders[window]) > 1:
                if now and i <= now[1]:
                    now[1] = i + 50
                else:
                    spans |= {(k, *now)} if now else set()
                    now = [i, i + 50]
        spans |= {(k, *now)} if now else set()
    return spans


def found(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = suffix_array.repeated_spans(docs).collect()
    assert all(r.other_doc_id in texts and r.other_doc_id != r.doc_id for r in rows)
    return {(r.doc_id, r.start_word, r.end_word) for r in rows}


def test_a_run_of_one_document_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "ROWS_PER_TASK", 20)
    passage = " ".join(f"word{i}" for i in range(60))
    own = " ".join(f"{passage} " + " ".join(f"own{i}x{j}" for j in range(i % 3 * 4 + 1)) for i in range(60))
    texts = {1: own, 2: f"before {passage}", 3: f"{passage} after"}
    assert found(spark, texts) == brute_force(texts)


def test_a_group_of_edited_copies(spark):
    """The best partners to the left and to the right of a seed differ, and a third document holds the passage between."""
    draw = random.Random(7)
    words = [f"word{i}" for i in range(400)]
    texts = {k: " ".join(f"edit{k}x{i}" if draw.random() < 1 / 20 else w for i, w in enumerate(words)) for k in range(400)}
    assert found(spark, texts) == brute_force(texts)
