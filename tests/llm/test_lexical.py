"""Ranked search against scoring every document."""

import collections
import math
import re

import numpy as np
import pytest

from loamsift.llm import lexical
from loamsift.operators.staging import stage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = "n string, terms string, counts string, code string, _item string, `rank` string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=10):
    """{item: [(doc_id, score)]} by scoring everything."""
    own = [(key, terms(text)) for key, text in docs]
    n_docs, total = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    held = collections.Counter(t for _, w in own for t in set(w))
    out = {}
    for item, text in items:
        scores = []
        for key, w in own:
            count, m = collections.Counter(w), 100 - 90 + (90 * len(w) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((1000000000 * count[t]) // (1000 * count[t] + 8 * m))
                for t in set(terms(text)) if count[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        if scores:
            out[item] = [(None if null else key, -score) for score, null, key in sorted(scores)[:top]]
    return out


def found(df):
    out = collections.defaultdict(dict)
    for r in df.collect():
        out[r.item_id][r["rank"]] = (r.doc_id, r.score)
    return {item: [rows[i + 1] for i in range(len(rows))] for item, rows in out.items()}


def corpus(seed, n):
    """Topics with words of their own, common words, copies in bulk and near copies."""
    draw, rows = np.random.default_rng(seed), []
    for key in range(n):
        topic = draw.integers(0, 12)
        words = [f"t{topic}w{draw.zipf(1.5) % 40}" for _ in range(draw.integers(1, 60))] + [f"c{draw.integers(0, 8)}" for _ in range(20)]
        rows.append((key, " ".join(words)))
    copies = [(n + i, rows[3][1] + (f" x{i % 5}" if i % 2 else "")) for i in range(n // 3)]
    return rows + copies


def test_blocks_and_bounds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)  # several jobs
    docs = corpus(1, 900)
    draw = np.random.default_rng(2)
    items = [(i, " ".join(docs[k][1].split()[:25])) for i, k in enumerate(draw.integers(0, 900, 12).tolist())]
    items += [(90, "c1 c2 c3"), (91, "nothing here known"), (92, ""), (93, None), (None, "t1w1 c1 t1w1")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = lexical.rank_documents(frame.repartition(5), spark.createDataFrame(items, "item_id bigint, text string"))
    assert found(got) == ranked(docs, items)


def test_blocks_are_skipped_and_maxima_are_exact(spark, monkeypatch):
    docs = corpus(3, 1500)
    rows = stage(lexical.forward(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id"), "t")
    index, sizes = lexical.build_index(rows)
    assert sizes == (len(docs), sum(len(terms(t)) for _, t in docs))
    shards = [lexical.Shard(r.asDict()) for r in index.collect()]
    assert sum(len(s.doc_ids) for s in shards) == len(docs)
    # The same on the driver, with blocks and columns cut more finely than in the tasks.
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 32)
    monkeypatch.setattr(lexical, "COLUMNS", 100)
    own = [(r.doc_id, r.n, np.array(r.terms, np.int64), np.array(r.counts, np.int64)) for r in rows.orderBy("doc_id").limit(700).collect()]
    fine = lexical._blocks(lexical._Lists(own, sizes), np.ones(lexical.DF_CELLS, np.int64), sizes[0])
    fine = lexical.Shard({name: x if name == "doc_ids" else x.tobytes() for name, x in fine.items()})
    monkeypatch.undo()
    for s, most_docs in [*((s, lexical.BLOCK_DOCS) for s in shards), (fine, 32)]:
        most = np.zeros((len(s.block_term), len(s.vocabulary)), np.int64)
        own = np.zeros((len(s.doc_ids), len(s.vocabulary)), np.int64)
        for d in range(len(s.doc_ids)):
            at = slice(s.doc_ptr[d], s.doc_ptr[d + 1])
            own[d, s.doc_terms[at]] = -(-s.impacts[at].astype(np.int64) // lexical.STEP)
        for t in range(len(s.vocabulary)):
            most[s.max_blocks[s.max_ptr[t] : s.max_ptr[t + 1]], t] = s.max_values[s.max_ptr[t] : s.max_ptr[t + 1]]
        lists, held = collections.defaultdict(list), np.bincount(s.doc_terms)
        for b, t in enumerate(s.block_term.tolist()):
            members = s.members[s.block_ptr[b] : s.block_ptr[b + 1]]
            assert 0 < len(members) <= most_docs
            assert (most[b] == (own[members].max(0) if held[t] > lexical.DIRECT else 0)).all()
            lists[t].extend(members.tolist())
        assert all(sorted(lists[t]) == np.flatnonzero(own[:, t]).tolist() for t in range(len(s.vocabulary)))
    query = lexical.forward(spark.createDataFrame([(1, docs[40][1])], "item_id bigint, text string"), "item_id").first().terms
    query = np.array(query, np.int64)
    weights, best = lexical.term_weights(rows, query, sizes[0]), []
    for s in shards:
        best = s.search(query, weights, best)
    assert [(key, -score) for score, _, key in best] == ranked(docs, [(1, docs[40][1])])[1]
    assert sum(s.skipped for s in shards) > sum(s.scored for s in shards)


def test_defined_cases(spark):
    long = "long " * 50_000 + "Needle"
    docs = [(1, None), (2, ""), (3, "--- !"), (4, long), (5, "needle ÉTÉ"), (5, "needle ÉTÉ"), (None, "needle ÉTÉ"), (6, "needle ÉTÉ"), (None, None)]
    items = [(1, "NEEDLE needle"), (2, "été"), (3, "ÉTÉ"), (4, None), (5, "long")]
    own = [f"'own' AS {c.split()[0]}" for c in CLASHES.split(", ")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", *own)
    tables = frame, spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", *own)
    got = found(lexical.rank_documents(*tables))
    assert got == ranked(docs, items) and 2 not in got and [k for k, _ in got[3]] == [5, 5, 6, None]
    assert lexical.rank_documents(tables[0].limit(0), tables[1]).count() == 0
    assert lexical.rank_documents(tables[0], tables[1].limit(0)).count() == 0
    assert found(lexical.rank_documents(*tables, top=2))[1] == ranked(docs, items, 2)[1]


def test_all_terms_where_the_queries_have_too_many(spark, monkeypatch):
    monkeypatch.setattr(lexical, "MAX_TERMS", 3)
    docs = corpus(5, 200)
    items = [(i, docs[i][1]) for i in range(5)]
    queries = lexical.query_terms(spark.createDataFrame(items, "item_id bigint, text string"))
    assert lexical.vocabulary_of(queries) is None
    got = lexical.rank_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert found(got) == ranked(docs, items)


@pytest.mark.parametrize("text", ["a1é", "A_b", "x\x7fy", "日本語 b"])
def test_terms(spark, text):
    row = lexical.forward(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), "doc_id").first()
    assert row.n == len(terms(text)) and len(row.terms) == len(set(terms(text)))
