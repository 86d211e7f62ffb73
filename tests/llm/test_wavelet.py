"""Wavelet shards against plain arrays and the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loamsift.llm import wavelet
from loamsift.llm.queries import QUERIES

ODD = ["<|endoftext|> a b", "", None, " x  y ", "It's WE'LL", "日本 語 text", "é ÇA é a ́b", "a　b\x1cc\x85d", "x<|startoftext|>y 12,5!!", "\n", "ΣΑΣ σας İ"]


@pytest.mark.parametrize("n, width", [(0, 3), (1, 1), (511, 5), (512, 5), (513, 16), (5000, 17)])
def test_matrix_against_a_plain_array(n, width):
    draw = np.random.default_rng(n)
    values = draw.integers(0, 1 << width, n).astype("<u2" if width <= 16 else "<u4")
    values[: n // 3] = 1  # a run that fills whole blocks
    matrix = wavelet.WaveletMatrix.of(values, width)
    assert (matrix.values() == values).all()
    at = draw.integers(0, n, 50) if n else np.zeros(0, np.int64)
    assert (matrix.access(at) == values[at]).all()
    for token in {1, 0, (1 << width) - 1, *values[-5:].tolist()}:
        places = np.flatnonzero(values == token)
        assert (matrix.select(token) == places).all() and matrix.rank(token) == len(places)
        assert all(matrix.rank(token, end) == (values[:end] == token).sum() for end in (0, n // 2, n))
        if len(places):
            assert matrix.select(token, [len(places) - 1, 0]).tolist() == [places[-1], places[0]]
    assert matrix.rank(1 << width) == 0


def expected(rows):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in order."""
    tokenizer, start, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for (key, _), found in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = [*found.ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op12_wavelet"](spark, SMALL).collect())
    assert got == expected(texts)


def test_odd_texts_over_several_shards_and_lookups(spark, tmp_path):
    rows = list(enumerate(ODD))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("own")).withColumn("part", F.lit("own"))
    wavelet.write_shards(docs.repartition(3), str(tmp_path / "shards"), shard_tokens=7)
    shards = wavelet.read_shards(spark, str(tmp_path / "shards"))
    assert shards.count() > 3
    assert len(list((tmp_path / "shards").glob("part-*"))) == shards.count()  # a file each
    found = wavelet.documents(shards, with_ids=True).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == expected(rows)
    ids = [x for r in found for x in np.frombuffer(r.ids, "<u4").tolist()]
    counts = {r.token: r.occurrences for r in wavelet.token_counts(shards, [1, ids[0], 49407, 48_999]).collect()}
    assert counts == {t: ids.count(t) for t in (1, ids[0], 49407, 48_999)}
    places = {(r.doc_id, r.offset, r.position) for r in wavelet.occurrences(shards, 1).collect()}
    assert places == {(r.doc_id, r.n_tokens - 1, r.start + r.n_tokens - 1) for r in found}
    wanted = spark.createDataFrame([(p,) for p in (0, 3, 3, len(ids) - 1, len(ids), -1)], "position bigint")
    assert {(r.position, r.token) for r in wavelet.tokens_at(shards, wanted).collect()} == {(p, ids[p]) for p in (0, 3, len(ids) - 1)}


def test_null_ids_repeated_rows_long_and_no_texts(spark):
    rows = [(None, "b"), (5, "same"), (5, "same"), (5, "Other text"), (1, None), (2, "long tail " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = wavelet.documents(wavelet.written(docs, shard_tokens=100)).collect()
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, 1, 2, 5, 5, 5]
    assert [r.start for r in order] == np.cumsum([0, *[r.n_tokens for r in order]])[:-1].tolist()
    assert sorted(r.ids_crc32 for r in order) == sorted(x[3] for x in expected(rows))
    assert wavelet.documents(wavelet.written(docs.limit(0))).count() == 0


def test_ids_over_16_bits(tmp_path):
    values = np.array([70_000, 3, 70_000, 65_536], "<u4")
    assert wavelet.WaveletMatrix.of(values, 17).values().tolist() == values.tolist()


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 5)
    import pyarrow as pa

    ids = wavelet._Ids(wavelet.default_vocabulary())
    for text in ("one two three", "two four five six", "one two seven eight nine ten eleven <|x", "six <|endoftext|>y"):
        found, edges = ids.batch(pa.array([text, None, text]))
        want = ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert found.tolist() == want * 2 and edges.tolist() == [0, len(want), len(want), 2 * len(want)]
