"""Ranked lexical search over posting lists in blocks of similar documents.

Every document becomes its terms with their counts; only the terms of a stated query set are kept if
there are at most ``MAX_TERMS`` of them, otherwise all. Documents are range-partitioned by a code of
similarity (signs of a random projection of their terms, so near copies lie together) and cut into
index shards of bounded size, one row each. Within a shard the posting list of every term is
clustered by document similarity: documents of the list go to the nearest of evenly spaced centres,
and clusters are cut into blocks. A block stores its documents and, in lists of more than ``DIRECT``
documents, the coordinatewise maximum of their term impacts (in steps of ``STEP``, rounded up, so it
is never too small).

A search goes through shards with a block of queries. The sum of a query's weights times a block's
maxima bounds the score of all its documents; a block is skipped only if that bound is below the
query's tenth score so far, and terms whose greatest impacts together stay below it need no lists at
all. Documents of other blocks are scored exactly, in whole numbers. Every task keeps ten rows per
query, and those of all tasks are ranked at the end, so the result is that of scoring everything.

Defined cases: a null text has no terms and is found by nothing. Repeated rows are found each; rows
that share score and id may change places; a null id comes after others of the same score. Items
without known terms have no rows. Empty tables give no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loamsift.llm import wordhash
from loamsift.operators.staging import new_path, stage

TOP = 10
MAX_TERMS = 1 << 20  # hashes sent to every task: 8 MB
QUERY_TERMS = 1 << 18  # terms of the queries that one job works off
SHARD_DOCS = 2048
SHARD_POSTINGS = 400_000
BLOCK_DOCS = 256
DIRECT = 32  # a list of so few documents is scored rather than bounded, as that is no more work
STEP = 4096  # impacts are below 1,000,000, so a byte is enough
COLUMNS = 2048  # terms looked at together while maxima are taken
CODE_BITS = 16
PROJECTION = 64
DF_CELLS = 1 << 16  # rough document frequencies, for similarity only
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
INDEX = (
    "doc_ids array<bigint>, vocabulary binary, doc_ptr binary, doc_terms binary, impacts binary,"
    " block_term binary, block_ptr binary, members binary, max_ptr binary, max_blocks binary, max_values binary"
)


def forward(rows: DataFrame, key: str, vocabulary: np.ndarray | None = None) -> DataFrame:
    """``key, n, terms, counts``: all terms counted in ``n``, distinct ones (of ``vocabulary``, sorted) as hashes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in wordhash.slices(whole)):
            raw, offsets = wordhash.flat(batch.column(1), lower=True)
            begins, ends = wordhash.spans(_TERM[raw], offsets)
            at = np.searchsorted(begins, offsets)
            doc, hashes = np.repeat(np.arange(batch.num_rows), np.diff(at)), wordhash.span_hashes(raw, begins, ends).view(np.int64)
            if vocabulary is not None:
                place = np.searchsorted(vocabulary, hashes)
                known = vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                doc, hashes = doc[known], hashes[known]
            order = np.lexsort((hashes, doc))
            doc, hashes = doc[order], hashes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(doc)))
            edges = pa.array(np.searchsorted(doc[first], np.arange(batch.num_rows + 1)).astype(np.int32))
            terms = pa.ListArray.from_arrays(edges, pa.array(hashes[first]))
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(at)), terms, pa.ListArray.from_arrays(edges, pa.array(counts))],
                [key, "n", "terms", "counts"],
            )

    text = rows.select(F.col(key).cast("bigint").alias(key), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(counted, f"{key} bigint, n bigint, terms array<bigint>, counts array<bigint>")


def query_terms(items: DataFrame, key: str = "item_id") -> DataFrame:
    """The written queries: a number of their own, their id and their distinct terms."""
    return stage(forward(items, key).select(F.monotonically_increasing_id().alias("_item"), key, "terms"), "op13_items")


def vocabulary_of(queries: DataFrame) -> np.ndarray | None:
    """The sorted terms of all queries, or None if they are more than ``MAX_TERMS``."""
    terms = queries.select(F.explode("terms").alias("term")).distinct()
    found = terms.limit(MAX_TERMS + 1).toPandas()["term"].to_numpy(np.int64)
    return np.sort(found) if len(found) <= MAX_TERMS else None


class _Lists:
    """Documents in code order, as arrays: whose terms, how often, and how strong."""

    def __init__(self, docs: list[tuple], sizes: tuple[int, int]):
        rows, total = sizes
        self.doc_ids = [row[0] for row in docs]
        each = np.array([len(row[2]) for row in docs], np.int64)
        n = np.array([row[1] for row in docs], np.int64)
        hashes, tf = np.concatenate([row[2] for row in docs]), np.concatenate([row[3] for row in docs])
        self.vocabulary, self.term = np.unique(hashes, return_inverse=True)
        self.doc = np.repeat(np.arange(len(docs)), each)
        self.doc_ptr = np.concatenate([[0], np.cumsum(each)])
        length = 100 - 90 + 90 * n * rows // total
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * length[self.doc])


def _signs(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A row of ``bits`` numbers of +1 or -1 for each term."""
    raw = wordhash.mixed(hashes.view(np.uint64)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : bits // 8]
    return np.unpackbits(raw, axis=1).astype(np.float32) * 2 - 1


def _rarity(hashes: np.ndarray, frequency: np.ndarray, rows: int) -> np.ndarray:
    return np.log1p(rows / np.maximum(1, frequency[hashes.view(np.uint64) % np.uint64(DF_CELLS)])).astype(np.float32)


def _small(n: int) -> str:
    """A kind of number that holds everything below ``n``."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    upto = np.cumsum(sizes)
    return np.repeat(begins - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)


def _blocks(lists: _Lists, frequency: np.ndarray, rows: int) -> dict:
    """The row of a shard: posting lists in blocks of similar documents, and the maxima of each block."""
    n_docs, n_terms = len(lists.doc_ids), len(lists.vocabulary)
    steps = (-(-lists.impact // STEP)).astype(np.uint8)
    weights = _rarity(lists.vocabulary, frequency, rows)[:, None] * _signs(lists.vocabulary, PROJECTION)
    point = np.zeros((n_docs, PROJECTION), np.float32)
    by_term = np.argsort(lists.term, kind="stable")
    list_ptr = np.searchsorted(lists.term[by_term], np.arange(n_terms + 1))

    def dense(low: int) -> np.ndarray:
        own = by_term[list_ptr[low] : list_ptr[min(n_terms, low + COLUMNS)]]
        table = np.zeros((n_docs, min(COLUMNS, n_terms - low)), np.uint8)
        table[lists.doc[own], lists.term[own] - low] = steps[own]
        return table

    for low in range(0, n_terms, COLUMNS):
        point += dense(low).astype(np.float32) @ weights[low : low + COLUMNS]
    point /= np.maximum(1e-9, np.linalg.norm(point, axis=1, keepdims=True))
    members, block_term, block_sizes = [], [], []
    for term in range(n_terms):
        own = lists.doc[by_term[list_ptr[term] : list_ptr[term + 1]]]
        sizes = [len(own)]
        if len(own) > BLOCK_DOCS:
            nearest = np.argmax(point[own] @ point[own[:: BLOCK_DOCS]].T, axis=1)
            own = own[np.argsort(nearest, kind="stable")]
            sizes = [min(BLOCK_DOCS, size - at) for size in np.bincount(nearest).tolist() for at in range(0, size, BLOCK_DOCS)]
        members.append(own), block_sizes.extend(sizes), block_term.extend([term] * len(sizes))
    members, block_ptr = np.concatenate(members), np.concatenate([[0], np.cumsum(block_sizes)])
    bounded = np.flatnonzero(np.diff(list_ptr)[block_term] > DIRECT).tolist()
    max_ptr, max_blocks, max_values = [np.zeros(1, np.int64)], [], []
    for low in range(0, n_terms, COLUMNS):
        table = dense(low)
        columns, blocks, values = [], [], []
        for block in bounded:
            most = table[members[block_ptr[block] : block_ptr[block + 1]]].max(axis=0)
            columns.append(np.flatnonzero(most).astype(np.uint16))
            blocks.append(np.full(len(columns[-1]), block, np.uint32))
            values.append(most[columns[-1]])
        if columns:
            columns, blocks, values = np.concatenate(columns), np.concatenate(blocks), np.concatenate(values)
            order = np.argsort(columns, kind="stable")
            max_ptr.append(max_ptr[-1][-1] + np.cumsum(np.bincount(columns, minlength=table.shape[1])))
            max_blocks.append(blocks[order]), max_values.append(values[order])
        else:
            max_ptr.append(np.repeat(max_ptr[-1][-1], table.shape[1]))
    return {
        "doc_ids": lists.doc_ids, "vocabulary": lists.vocabulary.astype("<i8"), "doc_ptr": lists.doc_ptr.astype("<i8"),
        "doc_terms": lists.term.astype(_small(n_terms)), "impacts": lists.impact.astype("<u4"), "block_term": np.array(block_term, "<u4"),
        "block_ptr": block_ptr.astype("<u4"), "members": members.astype("<u2"), "max_ptr": np.concatenate(max_ptr).astype("<i8"),
        "max_blocks": np.concatenate([np.zeros(0, np.uint32), *max_blocks]).astype(_small(len(block_term))),
        "max_values": np.concatenate([np.zeros(0, np.uint8), *max_values]),
    }


def build_index(rows: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The written index over written ``forward`` rows, a row per shard, and the corpus's (documents, terms)."""
    found = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("rows"), F.sum("n").alias("terms")).first()
    sizes = found["rows"], found["terms"] or 0
    cells = rows.select(F.explode("terms").alias("term")).groupBy((F.col("term").bitwiseAND(DF_CELLS - 1)).alias("cell")).count()
    frequency = np.zeros(DF_CELLS, np.int64)
    for cell in cells.collect():  # at most DF_CELLS rows
        frequency[cell["cell"]] = cell["count"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = (batch.column(name) for name in ("terms", "counts"))
            hashes, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            weight = _rarity(hashes, frequency, sizes[0]) * (tf / (tf + 1.0)).astype(np.float32)
            ends = np.cumsum(pc.list_value_length(terms).to_numpy())
            total = np.zeros((len(hashes) + 1, CODE_BITS))
            np.cumsum(weight[:, None] * _signs(hashes, CODE_BITS), axis=0, out=total[1:])
            sign = total[ends] > total[np.concatenate([[0], ends[:-1]])]
            code = sign @ (1 << np.arange(CODE_BITS))
            yield pa.record_batch([*batch.columns, pa.array(code.astype(np.int32))], [*batch.schema.names, "code"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, postings = [], 0

        def closed() -> pa.RecordBatch:
            row = _blocks(_Lists(docs, sizes), frequency, sizes[0])
            columns = [pa.array([row[name]], pa.list_(pa.int64())) if name == "doc_ids" else pa.array([row[name].tobytes()], pa.binary()) for name in row]
            return pa.record_batch(columns, list(row))

        for batch in batches:
            for doc_id, n, terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                terms, counts = terms.values.to_numpy(), counts.values.to_numpy()
                if docs and (len(docs) == SHARD_DOCS or postings + len(terms) > SHARD_POSTINGS):
                    yield closed()
                    docs, postings = [], 0
                docs.append((doc_id, n, terms, counts))
                postings += len(terms)
        if docs:
            yield closed()

    listed = rows.where(F.size("terms") > 0)
    coded_rows = listed.mapInArrow(coded, "doc_id bigint, n bigint, terms array<bigint>, counts array<bigint>, code int")
    coded_rows = stage(coded_rows.withColumn("_row", F.monotonically_increasing_id()), "op13_coded")
    # Copies share a code; the id and the row number spread them over partitions.
    order = ["code", "doc_id", "_row"]
    placed = coded_rows.repartitionByRange(*order).sortWithinPartitions(*order)
    path = new_path(rows.sparkSession, "op13_index")
    # Maxima of neighbouring blocks are much alike, so a slower compression pays.
    placed.select("doc_id", "n", "terms", "counts").mapInArrow(shards, INDEX).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(INDEX).parquet(path), sizes


class Shard:
    """One row of the index, for searching."""

    def __init__(self, row: dict):
        kinds = {
            "vocabulary": "<i8", "doc_ptr": "<i8", "doc_terms": _small(len(row["vocabulary"]) // 8), "impacts": "<u4", "block_term": "<u4",
            "block_ptr": "<u4", "members": "<u2", "max_ptr": "<i8", "max_blocks": _small(len(row["block_term"]) // 4), "max_values": "u1",
        }
        self.doc_ids = row["doc_ids"]
        for name, kind in kinds.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.members = self.members.astype(np.int64)
        self.block_ptr = self.block_ptr.astype(np.int64)
        self.first_block = np.searchsorted(self.block_term, np.arange(len(self.vocabulary) + 1))
        listed = np.diff(self.block_ptr[self.first_block])
        self.unbounded = np.flatnonzero(listed[self.block_term] <= DIRECT)
        self.strongest = np.zeros(len(self.vocabulary), np.int64)
        np.maximum.at(self.strongest, self.doc_terms, self.impacts)
        self.weight = np.zeros(len(self.vocabulary), np.int64)
        self.scored = self.skipped = 0  # blocks

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple], top: int = TOP) -> list[tuple]:
        """``best`` (rows of -score, id is null, id) with this shard's documents taken in."""
        at = np.searchsorted(self.vocabulary, terms)
        here = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == terms
        at, weights = at[here], weights[here]
        if not len(at):
            return best
        least = -best[-1][0] if len(best) == top else 1
        most = weights * self.strongest[at]
        order = np.argsort(most, kind="stable")
        needed = order[np.cumsum(most[order]) >= least]  # documents in none of these lists stay below
        if not len(needed):
            return best
        bounds = np.zeros(len(self.block_term), np.int64)
        for term, weight in zip(at.tolist(), weights.tolist()):
            own = slice(self.max_ptr[term], self.max_ptr[term + 1])
            bounds[self.max_blocks[own]] += weight * STEP * self.max_values[own].astype(np.int64)
        bounds[self.unbounded] = 1 << 62
        first = self.first_block[at[needed]]
        blocks = _ranges(first, self.first_block[at[needed] + 1] - first)
        blocks = blocks[np.argsort(-bounds[blocks], kind="stable")]
        limits, seen, turn, step = bounds[blocks], np.zeros(len(self.doc_ids), bool), 0, 16
        self.weight[at] = weights
        while turn < len(blocks) and limits[turn] >= least:
            now = blocks[turn : turn + step][limits[turn : turn + step] >= least]
            before = seen.copy()
            seen[self.members[_ranges(self.block_ptr[now], self.block_ptr[now + 1] - self.block_ptr[now])]] = True
            docs = np.flatnonzero(seen & ~before)
            turn, step = turn + len(now), min(256, 2 * step)
            self.scored += len(now)
            if not len(docs):
                continue
            scores = self._scores(docs)
            good = scores >= least
            new = [(-score, doc is None, doc or 0) for score, doc in zip(scores[good].tolist(), (self.doc_ids[d] for d in docs[good]))]
            if new:
                best = sorted(best + new)[:top]
                least = -best[-1][0] if len(best) == top else 1
        self.skipped += len(blocks) - turn
        self.weight[at] = 0
        return best

    def _scores(self, docs: np.ndarray) -> np.ndarray:
        size = self.doc_ptr[docs + 1] - self.doc_ptr[docs]
        at = _ranges(self.doc_ptr[docs], size)
        return np.add.reduceat(self.weight[self.doc_terms[at]] * self.impacts[at].astype(np.int64), np.cumsum(size) - size)


def term_weights(rows: DataFrame, terms: np.ndarray, documents: int) -> np.ndarray:
    """The weight of each term from the number of documents that hold it."""
    spark = rows.sparkSession
    table = F.broadcast(spark.createDataFrame(pa.table({"term": terms})))  # at most QUERY_TERMS rows
    counts = rows.select(F.explode("terms").alias("term")).join(table, "term").groupBy("term").count()
    held = {row["term"]: row["count"] for row in counts.collect()}
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(t, 0) + 1))) for t in terms.tolist()], np.int64)


def _search_block(rows: DataFrame, index: DataFrame, documents: int, block: list, key: str, top: int) -> DataFrame:
    """The best documents of each query in ``block`` (rows of number, id, terms)."""
    terms = np.unique(np.concatenate([np.array(terms, np.int64) for _, _, terms in block]))
    weights = term_weights(rows, terms, documents)
    queries = []
    for number, item, own in block:
        own = np.array(own, np.int64)
        queries.append((number, item, own, weights[np.searchsorted(terms, own)]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[i].as_py() for name in batch.schema.names})
                for number, _, own, weight in queries:
                    best[number] = shard.search(own, weight, best.get(number, []), top)
        found = [(number, item, doc if not null else None, -score) for number, item, _, _ in queries for score, null, doc in best.get(number, [])]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.record_batch([pa.array(list(x), pa.int64()) for x in columns], ["_item", key, "doc_id", "score"])

    found = index.mapInArrow(searched, f"_item bigint, {key} bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(key, "rank", "doc_id", "score")


def search(rows: DataFrame, index: DataFrame, sizes: tuple[int, int], queries: DataFrame, key: str = "item_id", top: int = TOP) -> DataFrame:
    """``key, rank, doc_id, score`` for written ``queries``, worked off in blocks of ``QUERY_TERMS`` terms.

    ``rows`` are the ``forward`` rows the index was built over.
    """
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "op13_found")
    schema = f"{key} bigint, rank int, doc_id bigint, score bigint"
    if not sizes[0] or not queries.where(F.size("terms") > 0).head(1):
        return spark.createDataFrame([], schema)
    block, held = [], 0

    def work() -> None:
        _search_block(rows, index, sizes[0], block, key, top).write.mode("append").parquet(path)

    for row in queries.where(F.size("terms") > 0).select("_item", key, "terms").toLocalIterator():
        if block and held + len(row["terms"]) > QUERY_TERMS:
            work()
            block, held = [], 0
        block.append((row["_item"], row[key], row["terms"]))
        held += len(row["terms"])
    work()
    return spark.read.schema(schema).parquet(path)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents for the text of every item."""
    queries = query_terms(items)
    rows = stage(forward(docs, "doc_id", vocabulary_of(queries)), "op13_rows")
    index, sizes = build_index(rows)
    return search(rows, index, sizes, queries, top=top)
