"""The registered queries against SQL, or against brute force where SQL can't express them."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from check_oracle import TABLES, rows_of
from conftest import SMALL
from loamsift.llm import packing, quality
from loamsift.llm.oracle import ORACLE
from loamsift.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    df, result = QUERIES[name](spark, SMALL), db.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(result.columns, result.fetchall())


def test_only_these_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"op5_quality", "op6_class_lm", "op7_shards", "op9_pack", "op12_wavelet"}
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_quality_counts_and_held_out_labels(spark, texts):
    rows = QUERIES["op5_quality"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        words, seen, dup_lines = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup_lines += line in seen
                seen.add(line)
        windows = list(zip(words, words[1:], words[2:]))
        times, covered = collections.Counter(windows), set()
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered |= {i, i + 1, i + 2}
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup_lines, len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_classifier_tells_held_out_rows_apart(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    training = labels.where("doc_id % 3 <> 0")
    model = quality.fit(docs, training)
    held = quality.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed").collect()
    right = sum((r.probability >= 0.5) == bool(r.quality) for r in held) / len(held)
    assert right > 0.95 and sum(r.quality == 0 for r in held) > 3
    assert sum(r.kept for r in held if r.quality) / sum(r.quality for r in held) > 0.97


def test_language_model_base_scores_and_gain(spark, texts):
    rows = QUERIES["op6_class_lm"](spark, SMALL).collect()
    tokens = {k: [*WORD.findall(t.translate(LOWER)), None] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    count = collections.Counter(w for k, t in tokens.items() if not held[k] for w in t)
    total, distinct = sum(count.values()), len(count)
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        want = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), total)
        assert r.n_known == sum(count[w] > 0 for w in own) and r.base_score == pytest.approx(want, rel=1e-9)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_model_is_a_distribution(spark):
    """Next-token probabilities over all known words, the end and an unknown word of each shape sum to one."""
    from pyspark.sql import functions as F

    from loamsift.llm import class_lm

    docs = spark.createDataFrame([(i, f"a b c{i % 3} d. e{i} a b") for i in range(40)], "doc_id bigint, text string")
    blocks = class_lm.tokenised(docs, F.lit(False))
    words = class_lm.vocabulary(blocks)
    model = class_lm.fit(blocks, words, classes=3, rounds=2, min_share=0.01)
    assert np.allclose((10 ** model["transition"]).sum(-1), 1)
    n = len(model["common"])
    inside = collections.defaultdict(float)
    for code in range(n):
        own = model["classes"][code]
        inside[own] += (model["count"][code] + class_lm.ADDED) / model["mass"][own]
    assert all(value == pytest.approx(1) for value in inside.values())


def test_shards(spark, texts):
    rows = QUERIES["op7_shards"](spark, SMALL).collect()
    by = collections.defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(24)) and {len(x) for x in by.values()} <= {len(texts) // 24, len(texts) // 24 + 1}
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_packed_pieces_are_the_tokenizers_ids(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, pieces, sequences = QUERIES["op9_pack"](spark, SMALL).collect(), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, found in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)):
        ids, at = [*found.ids, 2], 0
        for number, r in enumerate(sorted(pieces[key], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at) and (number == 0 or r.length == 1024)
            assert zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids) and (at > 1024 or len(pieces[key]) == 1)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    # A few per cent over the number that the tokens alone would need.
    assert len(sequences) <= 1.05 * -(-sum(r.length for r in rows) // 1024)


ODD = [
    "<|endoftext|> a  b", "", "  x", " x y ", "a \n b", "a\n \nb", "x   y z", "it's we'll 'd", None, "a　b c", "日本 語 text", "\x1c a \x1c b",
    "a  b — c", "<|endoftext|>", "foo<|endoftext|>bar baz", "a <| b |>", "tab\tx \ty z", "1234567 8 90,000.5!!", "a\x85 \x85b c", "é ça va ?",
]


def test_ids_of_odd_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.tokenise(docs).collect()}
    for i, text in enumerate(ODD):
        assert got[i] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], text


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_and_is_close_to_the_bound(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(1 + (draw.gamma(1.0, 250, 3000)).astype(int), 1024)
    patterns = packing.plan(collections.Counter(lengths.tolist()))
    used = collections.Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 1024 and times > 0
        for length in pattern:
            used[length] += times
    assert used == collections.Counter(lengths.tolist())
    assert sum(times for _, times in patterns) <= 1.01 * -(-lengths.sum() // 1024) + 1


def shingles(text):
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_stages_one_by_one(spark, tmp_path):
    """Every stage against plain Python on what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))).collect()}
    before, columns = docs.collect(), docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        now = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality rules":
            assert sorted(r.doc_id for r in now) == sorted(k for k, kept in verdict.items() if kept)
        if name == "exact dedup":
            groups = collections.defaultdict(list)
            for r in before:
                groups[hashlib.sha256("".join(WORD.findall(r.text)).encode()).digest()].append((-len(r.text), r.doc_id))
            assert sorted(r.doc_id for r in now) == sorted(min(g)[1] for g in groups.values())
        if name == "near dedup":
            sets, root = {r.doc_id: shingles(r.text) for r in before}, {r.doc_id: r.doc_id for r in before}
            for a in sorted(sets):
                for b in sets:
                    both = len(sets[a] & sets[b])
                    if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        low, high = sorted((root[a], root[b]))
                        root = {k: low if v == high else v for k, v in root.items()}
            assert sorted(r.doc_id for r in now) == sorted(set(root.values()))
        if name == "mixing":
            size = {r.doc_id: len(WORD.findall(r.text)) for r in before}
            assert max(collections.Counter(r.doc_id for r in now).values()) <= 2
            assert sum(size[r.doc_id] for r in now) == pytest.approx(1.5 * sum(size.values()), rel=0.2)
        if name == "packing":
            assert collections.Counter(r.doc_id for r in now if r.piece == 0) == collections.Counter(r.doc_id for r in before)
            assert all(len(r.ids) == 2 * r.length for r in now)
        before = now
