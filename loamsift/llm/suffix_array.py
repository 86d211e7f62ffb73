"""Repeated passages by a sparse suffix array over words.

Suffixes are kept only at content-selected places: in every window of ``MIN_WORDS`` words the run of ``SEED``
words with the smallest hash, so two texts that share a window keep the same place in it. A seed
that only one document holds is dropped before any text is moved. The other suffixes, cut to the words that
the next kept one does not cover, are range-partitioned and sorted; each is compared with its neighbours
of other documents and the match is extended to the left. A second order, by what stands to the left and
extended to the right, finds the partner with whom the left part is longest. Matches of ``MIN_WORDS`` words or more
become spans, and overlapping spans of a document one span.

The two orders give the longest agreement on either side, and what lies within both but in no match is open: a third document
may hold it. All windows of ``MIN_WORDS`` words at the seeds where one is open are hashed, and the documents counted per hash.

Partitions are bounded by rows, not by seeds, so a passage that a third of all documents hold is sorted by
many tasks. Rows of one document that stand together are a run. All rows of the first and the last run of a partition get the
nearest row of another document from the partitions beyond it, however many of those the run goes through.

Words are compared by 32-bit hashes with A-Z in lower case; a match is at least ``MIN_WORDS`` of them in a row.
Defined cases: null, empty and short texts have no spans. Rows that repeat an id and text are one document and
share their spans. A passage that repeats within one document alone is none. An empty table gives no rows. Other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loamsift.llm import wordhash
from loamsift.llm.common import SPACE, releasing, text_of
from loamsift.operators.staging import stage

MIN_WORDS = 50
SEED = 10
ROWS_PER_TASK = 60_000
LEFT, RIGHT = MIN_WORDS - SEED, MIN_WORDS  # words of context on either side: up to the next kept suffix
_LAST = np.uint64((1 << 64) - 1)

SEEDS = "doc_id bigint, _text_hash bigint, seed bigint, place int"
SUFFIXES = "doc_id bigint, _text_hash bigint, seed bigint, place int, before binary, after binary"
PAIRS = "doc_id bigint, _text_hash bigint, seed bigint, place int, left int, right int, other_doc_id bigint"
COMPARED = SUFFIXES + ", left int, right int, other_doc_id bigint, part int, kind tinyint"
# Fixed values of ``kind``; the pairs have none. A partition offers its outermost rows of two documents at either end.
FIRST, SECOND, LAST_BUT_ONE, LAST, NEEDS_ABOVE, NEEDS_BELOW = range(6)
WINDOWS = "doc_id bigint, _text_hash bigint, doc bigint, first int, hash bigint"
HASHED_ROWS = 10_000  # rows whose windows are hashed at once
HANDED = "part int, kind tinyint, h_seed bigint, h_doc_id bigint, h_before binary, h_after binary"


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each run of ``width`` neighbours."""
    step, now = 1, values
    while 2 * step <= width:
        now = best(now[:-step], now[step:])
        step *= 2
    rest = width - step
    return best(now[: len(now) - rest], now[rest:]) if rest else now


def seed_places(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept places among the words of a batch, and the hashes of the seeds there."""
    width = MIN_WORDS - SEED + 1  # seeds in a window
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = wordhash.runs_of(words, SEED)
    least = _sliding(seeds, width, np.minimum)
    # Windows that reach into the next text don't count.
    least = np.where(owner[: len(least)] == owner[MIN_WORDS - 1 :], least, np.uint64(0))
    padding = np.zeros(width - 1, np.uint64)
    # A seed is kept if it is the smallest of some window around it.
    most = _sliding(np.concatenate([padding, least, padding]), width, np.maximum)
    places = np.flatnonzero(most == seeds)
    return places, seeds[places]


@releasing
def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in wordhash.slices(batch):
            words, at = wordhash.text_words(part.column("text"), lower=True)
            places, seeds = seed_places(words, at)
            row = np.searchsorted(at, places, "right") - 1
            yield pa.record_batch([
                part.column("doc_id").take(pa.array(row)), part.column("_text_hash").take(pa.array(row)),
                pa.array(seeds.view(np.int64)), pa.array((places - at[row]).astype(np.int32)),
            ], ["doc_id", "_text_hash", "seed", "place"])


@releasing
def _with_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words before and after each kept place: 32-bit hashes, nearest first, 0 beyond the text."""
    for batch in batches:
        for part in wordhash.slices(batch):
            words, at = wordhash.text_words(part.column("text"), lower=True)
            short = (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            listed = part.column("found")
            upto = np.asarray(listed.offsets, np.int64)
            row = np.repeat(np.arange(part.num_rows), np.diff(upto))
            own = listed.flatten()
            place = own.field("place").to_numpy().astype(np.int64)

            def around(steps: np.ndarray) -> pa.Array:
                there = (place + at[row])[:, None] + steps[None, :]
                inside = (there >= at[row][:, None]) & (there < at[row + 1][:, None])
                found = np.where(inside, short[np.clip(there, 0, max(0, len(short) - 1))], np.uint32(0)) if len(short) else there.astype(np.uint32)
                ends = np.arange(len(found) + 1, dtype=np.int32) * np.int32(4 * len(steps))
                return pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(found))])

            yield pa.record_batch([
                part.column("doc_id").take(pa.array(row)), part.column("_text_hash").take(pa.array(row)), own.field("seed"), own.field("place"),
                around(-1 - np.arange(LEFT)), around(np.arange(RIGHT)),
            ], [x.split()[0] for x in SUFFIXES.split(", ")])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the first on are equal."""
    return np.logical_and.accumulate((a == b) & (a > 0), axis=1).sum(1)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _words_of(column: pa.Array, width: int) -> np.ndarray:
    """The words of each row, as a view of the column's own buffer: all values are of one size."""
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros((0, width), np.uint32)
    first = int(np.frombuffer(ends, np.int32)[column.offset])
    return np.frombuffer(data, np.uint8)[first : first + 4 * width * len(column)].view(np.uint32).reshape(len(column), width)


def _documents(rows: pa.RecordBatch) -> np.ndarray:
    """A number for each row's document."""
    ids = rows.column("doc_id").fill_null(-1).to_numpy()
    return wordhash.mixed(ids.view(np.uint64)) + rows.column("_text_hash").to_numpy().view(np.uint64)


@releasing
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within one sorted partition, the rows it offers to others, and the rows that need one of another partition."""
    kept = [batch for batch in batches if batch.num_rows]
    if not kept:
        return
    part = TaskContext.get().partitionId()
    rows = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
    n = rows.num_rows
    seed, doc_id, doc = rows.column("seed").to_numpy(), rows.column("doc_id"), _documents(rows)
    before, after = _words_of(rows.column("before"), LEFT), _words_of(rows.column("after"), RIGHT)
    begins = np.concatenate([[True], doc[1:] != doc[:-1]])  # of runs of one document's rows
    run = np.cumsum(begins) - 1
    first_of = np.flatnonzero(begins)
    ends_at = np.append(first_of[1:], n)
    names = _names(COMPARED)
    for other in (first_of[run] - 1, ends_at[run]):
        mine = np.flatnonzero((other >= 0) & (other < n))
        mine = mine[seed[mine] == seed[other[mine]]]
        theirs = other[mine]
        left, right = _common(before[mine], before[theirs]), _common(after[mine], after[theirs])
        found = rows.select(names[:4]).take(pa.array(mine))
        nothing = pa.nulls(len(mine), pa.binary())
        yield pa.record_batch([
            *[found.column(name) for name in names[:4]], nothing, nothing, pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)),
            doc_id.take(pa.array(theirs)), pa.nulls(len(mine), pa.int32()), pa.nulls(len(mine), pa.int8()),
        ], names)
    ends = [(FIRST, 0), (LAST, n - 1)]
    if len(first_of) > 1:
        ends += [(SECOND, ends_at[0]), (LAST_BUT_ONE, first_of[-1] - 1)]
    kinds = np.concatenate([[kind for kind, _ in ends], np.full(ends_at[0], NEEDS_ABOVE), np.full(n - first_of[-1], NEEDS_BELOW)])
    outer = rows.take(pa.array(np.concatenate([[at for _, at in ends], np.arange(ends_at[0]), np.arange(first_of[-1], n)]).astype(np.int64)))
    nothing = [pa.nulls(len(kinds), kind) for kind in (pa.int32(), pa.int32(), pa.int64())]
    yield pa.record_batch([*outer.columns, *nothing, pa.array(np.full(len(kinds), part, np.int32)), pa.array(kinds.astype(np.int8))], names)


def _handed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each partition the nearest row of another document above its first run and below its last one."""
    kept = [batch for batch in batches if batch.num_rows]
    if not kept:
        return
    rows = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
    doc = _documents(rows)
    by_part: dict[int, dict[int, int]] = {}
    for at, (part, kind) in enumerate(zip(rows.column("part").to_pylist(), rows.column("kind").to_pylist())):
        by_part.setdefault(part, {})[kind] = at
    found = []
    for parts, needs, near, far, next_far in (
        (sorted(by_part), NEEDS_ABOVE, FIRST, LAST, LAST_BUT_ONE), (sorted(by_part, reverse=True), NEEDS_BELOW, LAST, FIRST, SECOND),
    ):
        nearest = nearest_other = None  # the last row so far, and the last one of another document than that
        for part in parts:
            own = by_part[part]
            if nearest is not None and (hand := nearest if doc[nearest] != doc[own[near]] else nearest_other) is not None:
                found.append((part, needs, hand))
            if next_far in own:
                nearest_other = own[next_far]
            elif nearest is not None and doc[nearest] != doc[own[far]]:
                nearest_other = nearest
            nearest = own[far]
    at = pa.array([hand for *_, hand in found], pa.int64())
    given = rows.take(at)
    yield pa.record_batch([
        pa.array([part for part, *_ in found], pa.int32()), pa.array([kind for _, kind, _ in found], pa.int8()), given.column("seed"),
        *[given.column(name) for name in ("doc_id", "before", "after")],
    ], _names(HANDED))


def _with_handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows and the row that was handed to them."""
    for batch in batches:
        batch = batch.filter(pc.equal(batch.column("seed"), batch.column("h_seed")))
        left = _common(_words_of(batch.column("before"), LEFT), _words_of(batch.column("h_before"), LEFT))
        right = _common(_words_of(batch.column("after"), RIGHT), _words_of(batch.column("h_after"), RIGHT))
        pairs = [batch.column(name) for name in _names(PAIRS)[:4]]
        pairs += [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), batch.column("h_doc_id")]
        yield pa.record_batch(pairs, _names(PAIRS))


def _neighbour_pairs(suffixes: DataFrame, order: list[str]) -> DataFrame:
    """Neighbours of different documents in ``order``, across partitions too, and how far they agree on either side."""
    tasks = max(1, -(-suffixes.count() // ROWS_PER_TASK))
    ranged = suffixes.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    compared = stage(ranged.mapInArrow(_compared, COMPARED), "op10_compared")
    found = compared.where("kind IS NULL").select(*_names(PAIRS))
    if tasks == 1:
        return found
    # At most four rows per partition go to one task, two come back.
    offers = compared.where(F.col("kind") < NEEDS_ABOVE).coalesce(1)
    handed = stage(offers.mapInArrow(_handed_on, HANDED), "op10_handed")
    needing = compared.where(F.col("kind") >= NEEDS_ABOVE).select(*_names(SUFFIXES), "part", "kind")
    return found.unionByName(stage(needing.join(handed, ["part", "kind"]).mapInArrow(_with_handed, PAIRS), "op10_handed_pairs"))


def _windows_within(left, right):
    """Bit ``a`` for each window of ``MIN_WORDS`` words that begins ``a`` words before the seed and lies within both sides."""
    low, one = F.lit(MIN_WORDS) - right, F.lit(1).cast("bigint")
    bits = F.call_function("shiftleft", one, left + 1) - F.call_function("shiftleft", one, low)
    return F.when(low <= left, bits).otherwise(F.lit(0).cast("bigint"))


@releasing
def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows at kept places that ``open`` has bits for."""
    for batch in batches:
        for begin in range(0, batch.num_rows, HASHED_ROWS):
            rows = batch.slice(begin, HASHED_ROWS)
            words = np.concatenate([_words_of(rows.column("before"), LEFT)[:, ::-1], _words_of(rows.column("after"), RIGHT)], axis=1)
            starts = np.arange(LEFT + 1)  # among the words around a place, the first of which is LEFT words before it
            whole = _sliding(words.T, MIN_WORDS, np.minimum).T > 0  # no window reaches beyond the text
            asked = (rows.column("open").to_numpy()[:, None] >> (LEFT - starts)) & 1 > 0
            row, start = np.nonzero(asked & whole)
            hashes = wordhash.runs_of(words.ravel().astype(np.uint64), MIN_WORDS)[row * words.shape[1] + start]
            own = rows.select(["doc_id", "_text_hash", "place"]).take(pa.array(row))
            yield pa.record_batch([
                own.column("doc_id"), own.column("_text_hash"), pa.array(_documents(rows).view(np.int64)[row]),
                pa.array((own.column("place").to_numpy() + start - LEFT).astype(np.int32)), pa.array(hashes.view(np.int64)),
            ], _names(WINDOWS))


def _open_windows(suffixes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Windows that other documents hold, at the seeds where pairs of neighbours leave one open."""
    key = ["doc_id", "_text_hash", "seed", "place"]
    sides = pairs.groupBy(*key).agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.bit_or(_windows_within(F.col("left"), F.col("right"))).alias("known")
    )
    left_open = _windows_within(F.col("left"), F.col("right")).bitwiseAND(F.bitwise_not("known"))
    open_seeds = sides.select("seed", left_open.alias("open")).where("open <> 0").groupBy("seed").agg(F.bit_or("open").alias("open"))
    asked = suffixes.join(stage(open_seeds, "op10_open"), "seed")
    windows = stage(asked.mapInArrow(_window_hashes, WINDOWS), "op10_windows")
    holders = windows.groupBy("hash").agg(
        F.min("doc").alias("_a"), F.max("doc").alias("_b"), F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most")
    )
    shared = stage(holders.where("_a < _b").select("hash", "_least", "_most"), "op10_held")
    other = F.when(F.col("_least").eqNullSafe(F.col("doc_id")), F.col("_most")).otherwise(F.col("_least"))
    return windows.join(shared, "hash").select("doc_id", "_text_hash", F.col("first"), (F.col("first") + MIN_WORDS).alias("last"), other.alias("other_doc_id"))


def kept_suffixes(docs: DataFrame) -> DataFrame:
    """Suffixes whose seed another document holds too, with their contexts (a written table)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), text_of().alias("text"))
    seeds = stage(rows.mapInArrow(_seeded, SEEDS), "op10_seeds")
    holders = seeds.groupBy("seed").agg(
        F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"), F.min("_text_hash").alias("_c"), F.max("_text_hash").alias("_d")
    )
    # Written, so that a seed which very many documents hold can be split in the join.
    shared = stage(holders.where("_a < _b OR _c < _d").select("seed"), "op10_shared")
    places = seeds.join(shared, "seed", "left_semi").groupBy("doc_id", "_text_hash").agg(
        F.collect_set(F.struct("place", "seed")).alias("found")
    )
    places = places.withColumnsRenamed({"doc_id": "_doc", "_text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    texts = rows.join(places.hint("shuffle_hash"), same).select("doc_id", "_text_hash", "text", "found")
    suffixes = texts.mapInArrow(_with_context, SUFFIXES)
    return stage(suffixes, "op10_suffixes")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, _text_hash, start_word, end_word, other_doc_id``: passages that another document holds too.

    ``other_doc_id`` is the smallest id among the partners that were compared.
    """
    suffixes = kept_suffixes(docs)
    tail = ["doc_id", "_text_hash", "place"]
    pairs = _neighbour_pairs(suffixes, ["seed", "after", "before", *tail]).unionByName(
        _neighbour_pairs(suffixes, ["seed", "before", "after", *tail])
    )
    matches = pairs.where(F.col("left") + F.col("right") >= MIN_WORDS).select(
        "doc_id", "_text_hash", (F.col("place") - F.col("left")).alias("first"), (F.col("place") + F.col("right")).alias("last"), "other_doc_id"
    ).unionByName(_open_windows(suffixes, pairs))
    matches = matches.groupBy("doc_id", "_text_hash", "first", "last").agg(F.min("other_doc_id").alias("other_doc_id"))
    by_doc = Window.partitionBy("doc_id", "_text_hash").orderBy("first", "last")
    reach = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= reach, 0).otherwise(1)
    spans = matches.withColumn("_new", begins).withColumn("_span", F.sum("_new").over(by_doc))
    return spans.groupBy("doc_id", "_text_hash", "_span").agg(
        F.min("first").cast("bigint").alias("start_word"), F.max("last").cast("bigint").alias("end_word"), F.min("other_doc_id").alias("other_doc_id")
    ).drop("_span")


def span_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, start_word, end_word, other_doc_id, passage``: the words of each span, joined by spaces."""
    words = F.array_remove(F.split(text_of(), SPACE + "+"), "")
    own = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(text_of()).alias("_hash"), words.alias("_words"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    passage = F.array_join(F.slice("_words", (F.col("start_word") + 1).cast("int"), (F.col("end_word") - F.col("start_word")).cast("int")), " ")
    return spans.join(own, same).select("doc_id", "start_word", "end_word", "other_doc_id", passage.alias("passage"))
