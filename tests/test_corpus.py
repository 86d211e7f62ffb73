"""Sources, sinks, streams and whole runs on the smallest tables."""

import hashlib
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of
from conftest import SMALL
from loamsift.config import SOURCE_CATALOG, IngestConfig, SourceSpec
from loamsift.operators import exact, staging
from loamsift.plans import corpus
from loamsift.sources import documents, tables

# The slow ones are run at a larger scale by check_oracle.py.
QUICK = [
    "source_catalog", "ingest_sources", "heuristic_filters", "annotate_quality", "ngram_signature", "exact_dup_audit",
    "file_positions", "exact_dedup_incremental", "fuzzy_matches", "hybrid_select", "dsir_select_per_source", "unimax_batches",
    "attribute_batch", "training_sequences", "stream_exact_dedup", "stream_annotate", "stream_dedup_batches",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    result = db.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got and got == rows_of(result.columns, result.fetchall())


def test_queries_have_sql():
    from loamsift.plans.oracle import ORACLE
    from loamsift.plans.queries import QUERIES

    # Edit distances of whole texts take SQL minutes; tests/test_edits.py compares them with a plain loop.
    assert set(QUERIES) - set(ORACLE) == {"edit_matches"} and set(ORACLE) <= set(QUERIES)
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["domain", "quality_class", "count"]


def test_ingest_reads_a_mapped_json_source(spark, tmp_path):
    lines = [{"doc_id": i, "content": c, "language": "go"} for i, c in enumerate(["x " * 12, "", None, "y " * 15, "short", "z " * 20])]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    spec = SourceSpec("code", "made", None, "train", "content", 1.0, 2, path=str(tmp_path))
    scanned = documents.read_source(spark, spec)
    assert scanned.columns == ["doc_id", "text", "domain", "source", "language", "title"]
    # Two of three times the cap are read first: ids 0..5, blanks among them use up the budget.
    assert sorted(r["doc_id"] for r in documents.prefix(scanned, 4).collect()) == [0, 3]
    rows = documents.ingest(scanned, spec, IngestConfig(prefix_factor=2)).collect()
    assert {r["doc_id"] for r in rows} == {0, 3}
    assert {(r["metadata"]["language"], r["source"], r["metadata"]["original_dataset"]) for r in rows} == {("go", "made", "made")}


def test_run_writes_every_stage(spark, tmp_path):
    docs = tables.documents(spark, SMALL)
    scanned = {s.domain: docs.where(F.col("domain") == s.domain) for s in SOURCE_CATALOG}
    out = str(tmp_path)
    result = corpus.run(corpus.ingest(scanned), out)
    rows = {r["stage"]: r["rows"] for r in spark.read.json(f"{out}/state").collect()}
    assert rows == {name: df.count() for name, df in result.items()}
    assert rows["raw"] > rows["processed"] > rows["selected"] == int(rows["processed"] * 0.95)
    assert rows["sampled"] == rows["sequences"] == rows["selected"]
    assert sorted(f for f in os.listdir(f"{out}/raw_jsonl") if f.startswith("domain=")) == sorted(
        f"domain={s.domain}" for s in SOURCE_CATALOG
    )
    stats = spark.read.json(f"{out}/processing_stats").first()
    assert stats["total_processed"] == rows["processed"]


def test_selection_can_restart_from_a_written_stage(spark, tmp_path):
    raw = tables.raw_documents(spark, SMALL)
    path = str(tmp_path / "processed")
    corpus.process(raw).write.parquet(path)
    one = corpus.select(spark.read.parquet(path)).select("doc_id", "selection_rank").orderBy("doc_id").collect()
    two = corpus.select(corpus.process(raw)).select("doc_id", "selection_rank").orderBy("doc_id").collect()
    assert one == two


def test_stages_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    real = spark.conf.get("spark.checkpoint.dir", None)
    root = staging.shared_root(spark)
    assert root == (real.rstrip("/") if real else staging._local_root)
    table = staging.stage(spark.range(3), "three")
    assert all(f.replace("file://", "").startswith(root.replace("file://", "")) for f in table.inputFiles())


def test_plan_has_no_single_task_window_or_product(spark):
    """The rows of the corpus never meet in one partition."""
    raw = tables.raw_documents(spark, SMALL)
    plan = exact.exact_dedup(raw)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_a_run_leaves_no_staged_tables(spark):
    with staging.staged_run(spark):
        path = staging.new_path(spark, "x")
        staging.stage(spark.range(3), "y")
        spark.range(3).write.parquet(path)
        folder = os.path.dirname(path)
        assert len(os.listdir(folder)) == 2
    assert not os.path.exists(folder) and os.path.dirname(staging.new_path(spark, "z")) == os.path.dirname(folder)


def test_overlapping_and_missing_ids(spark, raw_of):
    from loamsift.config import CorpusConfig, DedupConfig

    specs = [SourceSpec(name, "made", None, "train", "text", 0.5, 100) for name in ("web", "books", "news")]
    words = lambda name, i: " ".join(f"{name}{i}word{k}" for k in range(12))
    frames = {}
    for spec in specs:
        rows = [(i if spec.domain != "news" else None, words(spec.domain, i)) for i in range(5)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        frames[spec.domain] = documents.scan(df, spec, "doc_id" if spec.domain != "news" else None)
    cfg = CorpusConfig(sources=tuple(specs), dedup=DedupConfig(fuzzy=False))
    raw = corpus.ingest(frames, cfg)
    assert [(r["doc_id"], r["domain"]) for r in raw.orderBy("doc_id").collect()] == [
        (i, name) for i, name in enumerate(["web"] * 5 + ["books"] * 5 + ["news"] * 5)
    ]
    rows = corpus.process(raw, cfg).collect()
    assert len(rows) == 15 and len({r["hash_id"] for r in rows}) == 15
    with pytest.raises(ValueError):
        corpus.process(raw_of([("a b", "web")]).unionByName(raw_of([("c d", "web")])), cfg)
    with pytest.raises(ValueError):
        documents.keyed(frames["web"].unionByName(frames["news"]))


@pytest.mark.parametrize("split_bytes", ["64m", "700", "90"])
def test_positions_follow_the_files(spark, tmp_path, split_bytes):
    """The largest file is read first and cut up, and still its rows come after those of the file before it."""
    sizes = {"part-0": 2, "part-1": 50, "part-2": 5}
    for name, rows in sizes.items():
        (tmp_path / f"{name}.json").write_text("".join(json.dumps({"text": f"{name} row {i}"}) + "\n" for i in range(rows)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        spec = SourceSpec("web", "made", None, "train", "text", 1.0, 100, path=str(tmp_path))
        numbered = documents.keyed(documents.read_source(spark, spec))
        assert numbered.columns == ["doc_id", "text", "domain", "source", "language", "title"]
        got = [(r["doc_id"], r["text"]) for r in numbered.orderBy("doc_id").collect()]
        raw = corpus.ingest({"web": documents.read_source(spark, spec).where("NOT text LIKE '% 3'")})
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate(f"{name} row {i}" for name, rows in sizes.items() for i in range(rows)))
    assert raw.count() == 0  # three words a row are too few to be ingested


def test_the_older_of_two_files_keeps_a_shared_text(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    (tmp_path / "a.json").write_text(json.dumps({"text": text, "source": "old"}) + "\n")
    (tmp_path / "b.json").write_text("".join(json.dumps({"text": t, "source": "new"}) + "\n" for t in [text] + [f"{text} x{i} " * 2 for i in range(40)]))
    spec = SourceSpec("web", "made", None, "train", "text", 1.0, 100, path=str(tmp_path))
    kept = exact.exact_dedup(documents.keyed(documents.read_source(spark, spec)))
    assert [r["source"] for r in kept.where(F.col("text") == text).collect()] == ["old"] and kept.count() == 41


def test_dedup_switches_and_null_domains(raw_of):
    from loamsift.config import CorpusConfig, DedupConfig
    from loamsift.operators import stats

    text = " ".join(f"w{i}" for i in range(60))
    near = text + " more"
    raw = raw_of([(text, None), (text, "web"), (near, "web")])

    def kept(**switches):
        return sorted(r["doc_id"] for r in corpus.process(raw, CorpusConfig(dedup=DedupConfig(**switches))).collect())

    assert kept() == [0] and kept(fuzzy=False) == [0, 2] and kept(exact=False, fuzzy=False) == [0, 1, 2]
    assert kept(exact=False) == [0] and kept(keep="last") == [2] and kept(hash_type="xxhash") == [0]
    assert stats.raw_stats(raw).first()["domain_counts"] == {"unknown": 1, "web": 2}
    processed = corpus.process(raw, CorpusConfig(dedup=DedupConfig(exact=False, fuzzy=False)))
    assert stats.processing_stats(processed).first()["domain_distribution"] == {"unknown": 1, "web": 2}


def test_file_positions_of_files_in_ranges(spark, tmp_path, monkeypatch):
    """A folder's text is written by several tasks, in the order of its ids all the same."""
    from loamsift.plans import queries

    rows = [(i * 7 % 300, f"text {i}", ["en", "de", "fr", None][i % 4 if i % 9 == 0 else 0]) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "FILE_CHARS", 500)
    written = []
    monkeypatch.setattr(queries, "new_path", lambda _, name: written.append(f"{tmp_path}/{name}") or written[-1])
    got = {r["doc_id"]: r["text_md5"] for r in queries.file_positions(spark, str(tmp_path)).collect()}
    folder = {"en": 1, "de": 0}
    in_order = sorted(rows, key=lambda r: (folder.get(r[2], 2), r[0]))
    assert got == {i: hashlib.md5(row[1].encode()).hexdigest() for i, row in enumerate(in_order)}
    files = list((tmp_path / "unnumbered" / "file=1").glob("*.json"))
    assert len(files) > 1 and max(f.stat().st_size for f in files) < 10_000


def test_near_duplicate_queries_write_no_texts(spark, monkeypatch):
    from loamsift.plans import queries

    monkeypatch.setattr(queries, "stage", lambda _, name: pytest.fail(f"{name} was written"))
    for name in ("fuzzy_matches", "fuzzy_dedup"):
        assert queries.QUERIES[name](spark, SMALL).columns[0] == "doc_id"


def test_process_does_not_write_texts_between_its_steps(spark, raw_of, monkeypatch):
    from loamsift.operators import exact, fuzzy, staging
    from loamsift.plans import corpus

    written = {}
    for module in (corpus, exact, fuzzy):
        monkeypatch.setattr(module, "stage", lambda df, name: written.setdefault(name, staging.stage(df, name)), raising=False)
    text = "one two three four five six seven eight nine ten"
    rows = corpus.process(raw_of([(text, "web"), (text, "web"), (text + " eleven", "books"), ("short", "code")])).collect()
    assert sorted(r.doc_id for r in rows) == [0, 3]
    assert written and not [name for name, df in written.items() if {"text", "grams"} & set(df.columns)]


def test_stage_counts_writes_one_table_of_texts(spark, monkeypatch):
    from loamsift.operators import staging
    from loamsift.plans import queries

    written = {}
    monkeypatch.setattr(queries, "stage", lambda df, name: written.setdefault(name, staging.stage(df, name)))
    counts = {r.stage: r["rows"] for r in queries.QUERIES["stage_counts"](spark, SMALL).collect()}
    assert [name for name, df in written.items() if "text" in df.columns] == ["processed"]
    assert counts["raw"] == 200 and counts["train"] + counts["eval"] == counts["selected"] == counts["sampled"]


def test_overlapping_sources_meet_their_numbers_once(spark, monkeypatch):
    from loamsift.operators import staging
    from loamsift.plans import queries

    written = {}
    monkeypatch.setattr(queries, "stage", lambda df, name: written.setdefault(name, staging.stage(df, name)))
    queries.QUERIES["ingest_overlapping"](spark, SMALL)
    assert {"doc_id", "text"} <= set(written["ingested"].columns)


def test_ingest_writes_no_texts_and_ranks_only_what_it_cuts(spark, monkeypatch):
    """Numbering writes ids only, and sources that have no more rows than are wanted keep their texts where they are."""
    written = {}
    monkeypatch.setattr(documents, "stage", lambda df, name: written.setdefault(name, staging.stage(df, name)))
    frames = [spark.createDataFrame([(7, "b"), (3, "a")], "doc_id bigint, text string"), spark.createDataFrame([(3, "c"), (5, "d")], "doc_id bigint, text string")]
    rows = sorted(tuple(r) for r in documents.union_with_ids(frames).collect())
    assert rows == [(0, "a", 3), (1, "b", 7), (2, "c", 3), (3, "d", 5)]
    assert not any("text" in df.columns for df in written.values())
    rows = spark.createDataFrame([(7, "b"), (None, "x"), (3, ""), (5, "d"), (5, "d")], "doc_id bigint, text string")
    cut = sorted(tuple(r) for r in documents._first(rows, [F.col("doc_id")], 2).collect())
    assert cut == [(3, "")]  # the null comes first, and stands for no row
    monkeypatch.setattr(documents, "MAX_SINGLE_MERGE", 1)
    monkeypatch.setattr(documents, "add_rank", lambda *_: pytest.fail("ranked"))
    assert sorted(r.doc_id for r in documents._first(rows, [F.col("doc_id")], 5).collect()) == [3, 5, 5, 7]
