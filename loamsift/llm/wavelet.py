"""Token ids in files that can be searched: one wavelet matrix per shard.

Texts become token ids and an end mark. Documents lie one after another in ascending ``doc_id``
order (nulls first; rows that share an id by a hash of their token ids, so equal rows may stand in
either order), and that row of tokens is cut into shards between documents. A shard is one Parquet file
with one row: its document ids and lengths, and its tokens as a wavelet matrix, that is one plane
of bits per binary digit, highest first, each plane stably ordered by the planes before it, with
the number of ones before every block of ``BLOCK`` bits. From that one file, which Spark
compresses, come the token at any place, how often a token occurs before a place, where its k-th
occurrence is, and all tokens at once; nothing else is stored.

A shard is closed before the document that would take it over ``shard_tokens``, so a task holds one
shard, or one longer document. Tasks write through Spark's committer, so a lost executor leaves no
half-written file behind.

Defined cases: a null or empty text is just its end mark. Repeated rows are written each. An empty
table gives no shard and no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from loamsift.llm import wordhash
from loamsift.llm.common import small_side, text_of
from loamsift.operators.staging import new_path, stage

END_ID = 1
SHARD_TOKENS = 1 << 22
BLOCK = 512  # bits between two stored ranks
_WORDS = BLOCK // 64
CACHE_WORDS = 3_000_000
SCHEMA = (
    "part int, number int, n_tokens bigint, width int, doc_ids array<bigint>, lengths array<bigint>,"
    " zeros array<bigint>, planes array<binary>, ranks array<binary>"
)


class _Ids:
    """Ids of whole batches of texts; a distinct word is encoded once as long as the cache holds it.

    The vocabulary drops white space and joins nothing across it, so the ids of a text are those of
    its words one after another. New words are encoded together, with a special token between them.
    Known words are kept as sorted arrays, some 25 bytes each.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.separator = next(((number, token.content) for number, token in special.items()), (None, None))
        self._forget()

    def _forget(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.store, self.used = np.zeros(1 << 16, "<u4"), 0

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        plain = [i for i, word in enumerate(words) if self.separator and "<|" not in word]
        found: list = [None] * len(words)
        if plain:
            joined = self.separator.join(words[i] for i in plain)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            for i, begin, end in zip(plain, [0, *(x + 1 for x in ends)], ends, strict=False):
                found[i] = ids[begin:end]
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = np.array(self.tokenizer.encode(words[i], add_special_tokens=False).ids, "<u4")
        return found

    def _learn(self, keys: np.ndarray, words: list[str], may_forget: bool) -> None:
        if may_forget and len(self.keys) + len(keys) > CACHE_WORDS:
            self._forget()
        found = self._encoded(words)
        sizes = np.array([len(x) for x in found], np.int32)
        ids = np.concatenate(found)
        if self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.zeros(max(len(ids), self.used), "<u4")])
        self.store[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.starts, self.sizes = (np.insert(old, at, new) for old, new in ((self.keys, keys), (self.starts, starts), (self.sizes, sizes)))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins and ends among them."""
        raw, offsets = wordhash.flat(texts)
        begins, ends = wordhash.words(raw, offsets)
        keys, where, which = np.unique(wordhash.span_hashes(raw, begins, ends), return_index=True, return_inverse=True)
        for turn in range(2):  # again if the cache was emptied for the new words
            at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
            if len(new):
                data, own = raw.tobytes(), where[new]
                self._learn(keys[new], [data[a:b].decode() for a, b in zip(begins[own].tolist(), ends[own].tolist())], turn == 0)
        at = np.searchsorted(self.keys, keys)
        starts, sizes = self.starts[at], self.sizes[at].astype(np.int64)
        each = sizes[which]
        upto = np.cumsum(each)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.store[np.repeat(starts[which] - (upto - each), each) + np.arange(total)]
        return ids, np.concatenate([[0], upto])[np.searchsorted(begins, offsets)]


@functools.lru_cache(1)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_bits(vocabulary: str | None = None, end_id: int = END_ID) -> int:
    """Binary digits of the largest id."""
    ids = Tokenizer.from_file(vocabulary or default_vocabulary()).get_vocab(with_added_tokens=True).values()
    return max(1, int(max(end_id, *ids)).bit_length())


def encode(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """A row per document: ``doc_id, ids`` (little-endian numbers of 16 bits if all ids fit, else 32)."""
    path = vocabulary or default_vocabulary()
    kind = "<u2" if id_bits(path, end_id) <= 16 else "<u4"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], kind).tobytes()
        for batch in (part for whole in batches for part in wordhash.slices(whole)):
            ids, edges = _ids(path).batch(batch.column(1))
            ids, edges = ids.astype(kind), edges.tolist()
            rows = [ids[a:b].tobytes() + end for a, b in zip(edges, edges[1:])]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(encoded, "doc_id bigint, ids binary")


class WaveletMatrix:
    """The numbers of one shard as planes of bits. All methods take and return arrays."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros, self.width = n, zeros, len(zeros)
        self.planes = [np.frombuffer(x, "<u8") for x in planes]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @classmethod
    def of(cls, values: np.ndarray, width: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        for level in reversed(range(width)):
            bits = values & values.dtype.type(1 << level) != 0
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(-(-len(values) // BLOCK) * _WORDS, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.bitwise_count(words).reshape(-1, _WORDS).sum(1, dtype=np.int64)
            zeros.append(int(len(values) - ones.sum()))
            planes.append(words.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes())
            values = np.concatenate([values.take(np.flatnonzero(~bits)), values.take(np.flatnonzero(bits))])
        return cls(int(len(values)), zeros, planes, ranks)

    def _bits(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 6] >> (at & 63).astype("<u8") & np.uint64(1)).astype(bool)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        block, inside = at // BLOCK, at % BLOCK
        found = self.ranks[level][block].astype(np.int64)
        for word in range(_WORDS):
            open_bits = np.clip(inside - 64 * word, 0, 64)
            if not open_bits.any():
                break
            words = self.planes[level][np.minimum(block * _WORDS + word, max(0, len(self.planes[level]) - 1))]
            mask = np.where(open_bits == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(open_bits, 63).astype("<u8")) - np.uint64(1))
            found += np.bitwise_count(words & mask)
        return found

    def _place(self, level: int, turn: np.ndarray, one: bool) -> np.ndarray:
        """Where the one (or zero) stands that has ``turn`` of its kind before it."""
        before = self.ranks[level].astype(np.int64)
        if not one:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = np.searchsorted(before, turn, "right") - 1
        low, high = block * BLOCK, np.minimum((block + 1) * BLOCK, self.n)
        while (high - low > 1).any():  # at most nine steps
            middle = (low + high) // 2
            ones = self._ones(level, middle)
            left = (ones if one else middle - ones) > turn
            low, high = np.where(left | (high - low <= 1), low, middle), np.where(left & (high - low > 1), middle, high)
        return low

    def access(self, at: np.ndarray) -> np.ndarray:
        at, found = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(self.width):
            bit, ones = self._bits(level, at), self._ones(level, at)
            found = found << 1 | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return found

    def _interval(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before ``end`` stand below the last plane."""
        if not 0 <= token < 1 << self.width:
            return 0, 0
        low, high = 0, end
        for level in range(self.width):
            ones_low, ones_high = self._ones(level, np.array([low, high])).tolist()
            if token >> self.width - 1 - level & 1:
                low, high = self.zeros[level] + ones_low, self.zeros[level] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` before the place ``end``, or in all."""
        low, high = self._interval(token, self.n if end is None else end)
        return high - low

    def select(self, token: int, turns: np.ndarray | None = None) -> np.ndarray:
        """Places of the occurrences of ``token`` with these numbers (from 0), or of all."""
        low, high = self._interval(token, self.n)
        at = low + (np.arange(high - low) if turns is None else np.asarray(turns, np.int64))
        for level in reversed(range(self.width)):
            one = bool(token >> self.width - 1 - level & 1)
            at = self._place(level, at - (self.zeros[level] if one else 0), one)
        return at if turns is not None else np.sort(at)

    def values(self) -> np.ndarray:
        """All tokens. Planes are undone from the last to the first, without any lookup."""
        found = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for level in reversed(range(self.width)):
            bits = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty_like(found)
            above[np.flatnonzero(~bits)] = found[: self.zeros[level]]
            above[np.flatnonzero(bits)] = found[self.zeros[level] :] | found.dtype.type(1 << self.width - 1 - level)
            found = above
        return found


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write all documents' tokens to ``path``, one file per shard."""
    width = id_bits(vocabulary, end_id)
    kind = np.dtype("<u2" if width <= 16 else "<u4")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, doc_ids, tokens = TaskContext.get().partitionId(), 0, 0, [], []

        def closed() -> pa.RecordBatch:
            matrix = WaveletMatrix.of(np.frombuffer(b"".join(tokens), kind), width)
            row = {
                "part": part, "number": number, "n_tokens": matrix.n, "width": width, "doc_ids": doc_ids,
                "lengths": [len(x) // kind.itemsize for x in tokens], "zeros": matrix.zeros,
                "planes": [x.tobytes() for x in matrix.planes], "ranks": [x.tobytes() for x in matrix.ranks],
            }
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py()
                if doc_ids and held + len(ids) // kind.itemsize > shard_tokens:
                    yield closed()
                    number, held, doc_ids, tokens = number + 1, 0, [], []
                held += len(ids) // kind.itemsize
                doc_ids.append(doc_id), tokens.append(ids)
        if doc_ids:
            yield closed()

    numbers, texts = pa.list_(pa.int64()), pa.list_(pa.binary())
    ARROW = pa.schema([
        ("part", pa.int32()), ("number", pa.int32()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("doc_ids", numbers),
        ("lengths", numbers), ("zeros", numbers), ("planes", texts), ("ranks", texts),
    ])
    spark, held = docs.sparkSession, new_path(docs.sparkSession, "op12_ids")
    encode(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(held)
    ids = spark.read.schema("doc_id bigint, ids binary").parquet(held).withColumn("_hash", F.xxhash64("ids"))
    place = [F.col("doc_id").asc_nulls_first(), F.col("_hash")]  # narrow keys, as partition bounds come from a sample of them
    ordered = ids.repartitionByRange(*place).sortWithinPartitions(*place, "ids").select("doc_id", "ids")
    rows = ordered.mapInArrow(shards, SCHEMA)
    rows.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part, number, shard_start``: how many tokens all shards before hold.

    One sum per part is put in order (as many rows as the write had tasks), then shards within parts.
    """
    sizes = shards.select("part", "number", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_own"))
    parts = parts.select("part", F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return own.join(parts, "part").select("part", "number", (F.col("_before") + F.col("_inside")).cast("bigint").alias("shard_start"))


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for number in range(batch.num_rows):
            yield batch.slice(number, 1).to_pylist()[0]


def _with_starts(rows: DataFrame, shards: DataFrame) -> DataFrame:
    starts = stage(shard_starts(shards), "op12_starts")
    return rows.join(small_side(starts), ["part", "number"])


def documents(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document read back: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` (32 bits each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            values = _matrix(row).values().astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            ids = [values[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            columns = [
                pa.array([row["part"]] * len(ids), pa.int32()), pa.array([row["number"]] * len(ids), pa.int32()),
                pa.array(row["doc_ids"], pa.int64()), pa.array(ends - lengths), pa.array(lengths),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()), *([pa.array(ids, pa.binary())] if with_ids else []),
            ]
            yield pa.record_batch(columns, names)

    names = ["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "part int, number int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    rows = _with_starts(shards.mapInArrow(read, schema), shards)
    start = (F.col("shard_start") + F.col("inside")).alias("start")
    return rows.select("doc_id", start, "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """``token, occurrences`` over all shards for a given list of tokens; only ranks are looked up."""
    tokens = sorted(set(tokens))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            matrix = _matrix(row)
            found = [matrix.rank(token) for token in tokens]
            yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array(found, pa.int64())], ["token", "n"])

    rows = shards.mapInArrow(counted, "token bigint, n bigint")
    return rows.groupBy("token").agg(F.sum("n").alias("occurrences"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Every occurrence of ``token``: ``doc_id, offset`` in the document and ``position`` among all tokens."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at = _matrix(row).select(token)
            ends = np.cumsum(np.array(row["lengths"], np.int64))
            doc = np.searchsorted(ends, at, "right")
            starts = np.concatenate([[0], ends])[doc]
            own = [row["doc_ids"][i] for i in doc.tolist()]
            n = len(at)
            columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["number"]] * n, pa.int32())]
            yield pa.record_batch([*columns, pa.array(own, pa.int64()), pa.array(at - starts), pa.array(at)], names)

    names = ["part", "number", "doc_id", "offset", "inside"]
    rows = shards.mapInArrow(located, "part int, number int, doc_id bigint, offset bigint, inside bigint")
    return _with_starts(rows, shards).select("doc_id", "offset", (F.col("shard_start") + F.col("inside")).alias("position"))


def tokens_at(shards: DataFrame, positions: DataFrame) -> DataFrame:
    """``position, token`` for a table of distinct ``position`` values; places outside the corpus are left out.

    Places meet their shard by its number, so a task holds one shard and at most one place per token of it.
    """
    sizes = shards.select("part", "number", "n_tokens").join(shard_starts(shards), ["part", "number"])
    sizes = stage(sizes, "op12_sizes")
    inside = (F.col("position") >= F.col("shard_start")) & (F.col("position") < F.col("shard_start") + F.col("n_tokens"))
    placed = positions.select("position").distinct().join(small_side(sizes), inside)
    placed = placed.select("part", "number", "position", (F.col("position") - F.col("shard_start")).alias("inside"))

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        found = _matrix(right.to_pylist()[0]).access(left.column("inside").to_numpy())
        return pa.table([left.column("position"), pa.array(found, pa.int64())], ["position", "token"])

    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64())], ["position", "token"])
    keys = ["part", "number"]
    return placed.groupBy(*keys).cogroup(shards.groupBy(*keys)).applyInArrow(looked_up, "position bigint, token bigint")


def written(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards to the shared folder and return them as read back."""
    path = new_path(docs.sparkSession, "op12_shards")
    write_shards(docs, path, vocabulary, end_id, shard_tokens)
    return read_shards(docs.sparkSession, path)
