"""The store of hashes: what it finds, and how little a batch reads of it."""

import pytest
from pyspark.sql import functions as F

from loamsift.operators import exact
from loamsift.operators.seen import SeenHashes
from loamsift.streaming import documents as streaming


def hashes(spark, begin, end):
    return spark.range(begin, end).select(F.md5(F.col("id").cast("string")).alias("hash_id"))


def test_new_batches_read_no_hashes_and_a_copy_reads_one_file(spark, tmp_path):
    store = SeenHashes(spark, str(tmp_path / "seen"), buckets=16)
    read = []
    for number in range(4):
        batch = hashes(spark, 1000 * number, 1000 * number + 1000)
        found = store.seen(batch, number)
        read.append([f for f in found.inputFiles() if "/hashes/" in f])
        assert found.count() == 0
        store.add(batch, number)
    assert read == [[], [], [], []]  # filters alone, however many batches came before
    one_old = hashes(spark, 4000, 4500).union(hashes(spark, 1234, 1235))
    found = store.seen(one_old, 4)
    files = [f for f in found.inputFiles() if "/hashes/" in f]
    assert len(files) == 1 and "/batch=1/" in files[0]
    assert [r["hash_id"] for r in found.collect()] == [hashes(spark, 1234, 1235).first()["hash_id"]]


def test_all_that_was_seen_is_found_again(spark, tmp_path):
    store = SeenHashes(spark, str(tmp_path / "seen"))
    for number, (begin, end) in enumerate([(0, 700), (700, 701), (800, 800), (900, 1400)]):
        store.add(hashes(spark, begin, end), number)
    asked = hashes(spark, 0, 3000)
    assert store.seen(asked, 4).count() == 700 + 1 + 500
    assert store.seen(asked, 1).count() == 700 and store.seen(asked, 0).count() == 0
    store.add(hashes(spark, 2000, 2010), 1)  # done again with other rows
    assert store.seen(asked, 2).count() == 710
    assert store.seen(asked.limit(0), 4).count() == 0


def test_many_files_are_read_as_whole_batches(spark, tmp_path, monkeypatch):
    from loamsift.operators import seen

    monkeypatch.setattr(seen, "MAX_FILES", 3)
    store = SeenHashes(spark, str(tmp_path / "seen"), buckets=8)
    for number in range(2):
        store.add(hashes(spark, 100 * number, 100 * number + 100), number)
    assert store.seen(hashes(spark, 50, 250), 2).count() == 150


def test_batches_against_the_store_equal_one_run(spark, tmp_path, texts_of):
    texts = ["a", "b", "a", "", "c", "a", "", "b", "d"]
    df, store, kept = texts_of(texts), SeenHashes(spark, str(tmp_path / "seen")), []
    for number, (begin, end) in enumerate([(0, 3), (3, 6), (6, 9)]):
        batch = df.where(F.col("doc_id").between(begin, end - 1))
        for _ in range(2):  # a batch may be done again
            survivors = exact.exact_dedup_with_store(batch, store, number).collect()
            store.add(spark.createDataFrame([(r["hash_id"],) for r in survivors], "hash_id string"), number)
        kept += [r["doc_id"] for r in survivors]
    assert sorted(kept) == [0, 1, 3, 4, 8]


@pytest.mark.parametrize("restarts", [1, 3])
def test_stream_keeps_its_store_over_runs(spark, tmp_path, texts_of, restarts):
    arrived, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for number in range(restarts):
        texts_of(["x", "y", f"own {number}"]).withColumn("doc_id", F.col("doc_id") + 10 * number).write.mode("append").parquet(arrived)
        schema = spark.read.parquet(arrived).schema
        streaming.dedup_batches(streaming.read_stream(spark, arrived, schema, 1000), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted(r["text"] for r in rows.collect()) == sorted(["x", "y"] + [f"own {n}" for n in range(restarts)])
    assert {r["doc_id"] for r in rows.where("text = 'x'").collect()} == {0}
