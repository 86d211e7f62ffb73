"""A class-based n-gram language model: exchange clustering, class transitions, word emissions.

Texts become blocks of a few million tokens, each with the sorted hashes of its distinct words, so
that later steps look up a word once per block. Counts come from all training documents. Words
with a share of at least ``MIN_SHARE`` of all tokens, of which there can be no more than
``1 / MIN_SHARE``, are clustered; this list and their classes fit into every task. The other words
form fixed classes by their shape, so the class of every token is known within its block.

Clustering (Brown's criterion, by exchange) works on the neighbours of every clustered word, one row
per word: in each round every task moves the words of one half to the class that raises the
likelihood most, given the class pair counts of the round before. Text is then scored with class
trigrams, interpolated by Witten and Bell, times the probability of the word in its class. The
counts of rare words come back to the blocks by a join in which no word is frequent.

Defined cases: a null or empty text is its end token. A document without id is held out (its text
counts as '' for the split). Repeated rows count each. Without training tokens every word is
unknown. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from loamsift.llm import wordhash
from loamsift.llm.common import text_of
from loamsift.operators.staging import stage

CLASSES = 48
MIN_SHARE = 5e-6
ROUNDS = 8
BLOCK_TOKENS = 1 << 21
ADDED = 0.1  # added to every count, and once more for the unknown word
END = 0  # stands for the end token among the hashes
# What the last character of a rare word may be; with it goes whether all of it is ASCII.
LAST = ("abcdefghijklmnopqrstuvwxyz", "0123456789", ".!?", ",;:")
SHAPES = 2 * (len(LAST) + 1)
_LAST = np.full(256, len(LAST), np.int8)
for _number, _chars in enumerate(LAST):
    _LAST[list(_chars.encode())] = _number
_LAST[128:] = 0

BLOCKS = "block bigint, doc_ids array<bigint>, held_out array<boolean>, n_tokens array<int>, words array<bigint>, shapes array<tinyint>, counts array<int>, tokens binary"


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    number = TaskContext.get().partitionId() << 32
    ids, held, sizes, hashes, shapes, n = [], [], [], [], [], 0

    def block() -> pa.RecordBatch:
        size = np.concatenate(sizes)
        words, first, tokens = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        training = np.repeat(~np.concatenate(held), size)
        counts = np.bincount(tokens[training], minlength=len(words))
        columns = [
            pa.array([number]), pa.array([[x for part in ids for x in part.to_pylist()]], pa.list_(pa.int64())),
            pa.array([np.concatenate(held)], pa.list_(pa.bool_())), pa.array([size.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([words.view(np.int64)], pa.list_(pa.int64())), pa.array([np.concatenate(shapes)[first]], pa.list_(pa.int8())),
            pa.array([counts.astype(np.int32)], pa.list_(pa.int32())), pa.array([tokens.astype(np.int32).tobytes()], pa.binary()),
        ]
        return pa.record_batch(columns, names)

    for batch in batches:
        for part in wordhash.slices(batch):
            raw, offsets = wordhash.flat(part.column("text"), lower=True)
            begins, ends = wordhash.words(raw, offsets)
            word, at = wordhash.span_hashes(raw, begins, ends), np.searchsorted(begins, offsets)
            wide = np.concatenate([[0], np.cumsum(raw >= 128)])
            shape = (_LAST[raw[ends - 1]] + (len(LAST) + 1) * (wide[ends] > wide[begins])).astype(np.int8)
            hashes.append(np.insert(word, at[1:], np.uint64(END)))
            shapes.append(np.insert(shape, at[1:], 0))
            ids.append(part.column("doc_id")), held.append(part.column("held_out").to_numpy(zero_copy_only=False))
            sizes.append(np.diff(at) + 1)
            n += len(hashes[-1])
            if n >= BLOCK_TOKENS:
                yield block()
                number += 1
                ids, held, sizes, hashes, shapes, n = [], [], [], [], [], 0
    if n:
        yield block()


def tokenised(docs: DataFrame, held_out) -> DataFrame:
    """Blocks of tokens (a written table); ``held_out`` says which documents are not learnt from."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), text_of().alias("text"))
    return stage(rows.mapInArrow(_blocks_of, BLOCKS), "op6_blocks")


def vocabulary(blocks: DataFrame) -> DataFrame:
    """``word, c, shape`` of all words of training documents, the end token included (a written table)."""
    rows = blocks.select(F.explode(F.arrays_zip("words", "counts", "shapes")).alias("x")).select("x.*").where("counts > 0")
    return stage(rows.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c"), F.min("shapes").alias("shape")), "op6_words")


def _codes(words: np.ndarray, shapes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Numbers of words: their place among the clustered ones, then their shape, then the end token."""
    at = np.minimum(np.searchsorted(common, words), max(0, len(common) - 1))
    codes = len(common) + shapes.astype(np.int64)
    if len(common):
        codes = np.where(common[at] == words, at, codes)
    return np.where(words == np.uint64(END), len(common) + SHAPES, codes)


def _coded(batch: pa.RecordBatch, common: np.ndarray):
    """For each block: codes of its tokens, sizes of its documents, and which tokens are learnt from."""
    for row in range(batch.num_rows):
        words = batch.column("words")[row].values.to_numpy().view(np.uint64)
        codes = _codes(words, batch.column("shapes")[row].values.to_numpy(), common)
        tokens = np.frombuffer(batch.column("tokens")[row].as_buffer(), np.int32)
        size = batch.column("n_tokens")[row].values.to_numpy()
        held = batch.column("held_out")[row].values.to_numpy(zero_copy_only=False).astype(bool)
        yield codes[tokens], size, np.repeat(~held, size)


def _neighbours(blocks: DataFrame, common: np.ndarray) -> DataFrame:
    """A row per code: what stands before it and after it, and how often (a written table)."""
    n = len(common) + SHAPES + 1

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, _, learnt in _coded(batch, common):
                before = np.concatenate([[n - 1], codes[:-1]])  # the end of a text begins the next one
                found, times = np.unique(before[learnt] * n + codes[learnt], return_counts=True)
                yield pa.record_batch([pa.array((found // n).astype(np.int32)), pa.array((found % n).astype(np.int32)), pa.array(times)], ["a", "b", "n"])

    counted = blocks.select("words", "shapes", "tokens", "n_tokens", "held_out").mapInArrow(pairs, "a int, b int, n bigint")
    counted = stage(counted.groupBy("a", "b").agg(F.sum("n").alias("n")), "op6_pairs")
    # A code has at most as many neighbours as there are codes, which MIN_SHARE bounds.
    left = counted.groupBy(F.col("b").alias("code")).agg(F.collect_list("a").alias("left"), F.collect_list("n").alias("left_n"))
    right = counted.groupBy(F.col("a").alias("code")).agg(F.collect_list("b").alias("right"), F.collect_list("n").alias("right_n"))
    rows = left.join(right, "code", "full")
    empty_ints, empty_longs = F.array().cast("array<int>"), F.array().cast("array<bigint>")
    return stage(rows.select(
        "code", F.coalesce("left", empty_ints).alias("left"), F.coalesce("left_n", empty_longs).alias("left_n"),
        F.coalesce("right", empty_ints).alias("right"), F.coalesce("right_n", empty_longs).alias("right_n"),
    ), "op6_neighbours")


def _by_class(batch: pa.RecordBatch, side: str, classes: np.ndarray, n: int) -> np.ndarray:
    """Rows of counts by class of the neighbours on one side."""
    other, times = batch.column(side), batch.column(side + "_n")
    at = np.asarray(other.offsets, np.int64)
    row = np.repeat(np.arange(batch.num_rows), np.diff(at))
    flat = np.bincount(row * n + classes[other.flatten().to_numpy()], times.flatten().to_numpy(), batch.num_rows * n)
    return flat.reshape(batch.num_rows, n)


def _class_pairs(neighbours: DataFrame, classes: np.ndarray, n: int) -> np.ndarray:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            np.add.at(total, classes[batch.column("code").to_numpy()], _by_class(batch, "right", classes, n))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

    rows = neighbours.select("code", "right", "right_n").mapInArrow(summed, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n * n)
    out[[row["at"] for row in rows]] = [row["n"] for row in rows]
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _moves(neighbours: DataFrame, classes: np.ndarray, pairs: np.ndarray, movable: int, words: int, turn: int) -> np.ndarray:
    """Classes after the words of one half have moved to where they raise the likelihood most."""
    n = len(pairs)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_sum, in_sum, by_row, by_column = pairs.sum(1), pairs.sum(0), _xlogx(pairs), _xlogx(pairs.T)
        for batch in batches:
            code = batch.column("code").to_numpy()
            batch = batch.filter(pa.array((code < words) & (wordhash.mixed(code.astype(np.uint64)) % np.uint64(2) == turn % 2)))
            code = batch.column("code").to_numpy()
            left, right = _by_class(batch, "left", classes, n), _by_class(batch, "right", classes, n)
            best = np.empty(len(code), np.int64)
            for i, own in enumerate(classes[code]):
                l, r = left[i], right[i]
                rows, columns = pairs[:movable].copy(), pairs.T[:movable].copy()
                old_rows, old_columns = by_row[:movable].sum(1), by_column[:movable].sum(1)
                rows[own] = np.maximum(0, rows[own] - r)  # the word has left its class
                columns[own] = np.maximum(0, columns[own] - l)
                old_rows[own], old_columns[own] = _xlogx(rows[own]).sum(), _xlogx(columns[own]).sum()
                used_r, used_l = np.flatnonzero(r), np.flatnonzero(l)
                gain = (_xlogx(rows[:, used_r] + r[used_r]) - _xlogx(rows[:, used_r])).sum(1)
                gain += (_xlogx(columns[:, used_l] + l[used_l]) - _xlogx(columns[:, used_l])).sum(1)
                outs, ins = out_sum[:movable].copy(), in_sum[:movable].copy()
                outs[own], ins[own] = max(0, outs[own] - r.sum()), max(0, ins[own] - l.sum())
                gain -= _xlogx(outs + r.sum()) - _xlogx(outs) + _xlogx(ins + l.sum()) - _xlogx(ins)
                best[i] = gain.argmax() if gain.max() > gain[own] + 1e-9 else own
            yield pa.record_batch([pa.array(code), pa.array(best)], ["code", "class"])

    out = classes.copy()
    for row in neighbours.mapInArrow(moved, "code int, class bigint").collect():  # a number per clustered word
        out[row["code"]] = row["class"]
    return out


def _likelihood(pairs: np.ndarray) -> float:
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(1)).sum() - _xlogx(pairs.sum(0)).sum())


def cluster(neighbours: DataFrame, words: int, seeds: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of every code: clustered words, then one class per shape, then the end token's."""
    fixed = classes + np.arange(SHAPES + 1)
    now = np.concatenate([(seeds % np.uint64(classes)).astype(np.int64), fixed])
    n = classes + SHAPES + 1
    best, score = now, -np.inf
    for turn in range(rounds):
        pairs = _class_pairs(neighbours, now, n)
        if (value := _likelihood(pairs)) > score:
            best, score = now, value
        now = _moves(neighbours, now, pairs, classes, words, turn)
    return now if _likelihood(_class_pairs(neighbours, now, n)) > score else best


def _trigrams(blocks: DataFrame, common: np.ndarray, classes: np.ndarray, n: int) -> np.ndarray:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n**3, np.int64)
        for batch in batches:
            for codes, size, learnt in _coded(batch, common):
                total += np.bincount(_histories(classes[codes], size, n)[learnt], minlength=n**3)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = blocks.select("words", "shapes", "tokens", "n_tokens", "held_out").mapInArrow(counted, "at bigint, n bigint")
    out = np.zeros(n**3)
    for row in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most n^3 numbers
        out[row["at"]] = row["n"]
    return out.reshape(n, n, n)


def _histories(own: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """For each token its class and the two before it, as one number; a text begins after two ends."""
    one, two = np.full(len(own), n - 1), np.full(len(own), n - 1)
    one[1:], two[2:] = own[:-1], own[:-2]
    two[(np.cumsum(size) - size)[size > 0]] = n - 1
    return (two * n + one) * n + own


def fit(blocks: DataFrame, words: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, min_share: float = MIN_SHARE) -> dict:
    """Everything that scoring needs but the counts of rare words; bounded by ``min_share`` and ``classes``."""
    totals = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(totals["n"] or 0), int(totals["v"])
    limit = max(2, int(np.ceil(total * min_share)))
    rows = words.where((F.col("c") >= limit) & (F.col("word") != END)).select("word", "c").toArrow()
    common, count = rows.column("word").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    order = np.argsort(common)
    common, count = common[order], count[order]
    n = classes + SHAPES + 1
    neighbours = _neighbours(blocks, common)
    own = cluster(neighbours, len(common), wordhash.mixed(common), classes, rounds)
    # Tokens and types of each class; a shape has one more type, its unknown words.
    size, types = np.zeros(n), np.zeros(n)
    np.add.at(size, own[: len(common)], count)
    np.add.at(types, own[: len(common)], 1)
    for row in words.where((F.col("c") < limit) & (F.col("word") != END)).groupBy("shape").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        size[classes + row["shape"]], types[classes + row["shape"]] = row["n"], row["v"]
    types[classes : classes + SHAPES] += 1
    end = words.where(F.col("word") == END).select("c").first()
    size[-1], types[-1] = (end["c"] if end else 0), 1
    mass = size + ADDED * types
    three = _trigrams(blocks, common, own, n)
    two = three.sum(0)
    chance = mass / mass.sum()

    def smoothed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        seen, all_of = (counts > 0).sum(-1, keepdims=True), counts.sum(-1, keepdims=True)
        weight = np.maximum(seen, 1)
        return (counts + weight * lower) / (all_of + weight)

    transition = np.log10(smoothed(three, smoothed(two, chance)[None]))
    return {
        "common": common, "count": count, "classes": own, "n": n, "transition": transition, "mass": mass,
        "total": total, "distinct": distinct, "limit": limit,
    }


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(blocks: DataFrame, words: DataFrame, model: dict) -> DataFrame:
    """A row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = blocks.sparkSession
    common = F.broadcast(spark.createDataFrame(pa.table({"word": model["common"].view(np.int64)})))  # at most 1 / min_share rows
    rare = blocks.select("block", F.posexplode("words").alias("at", "word")).join(common, "word", "left_anti")
    rare = rare.join(words.where(F.col("c") < model["limit"]).select("word", "c"), "word").select(F.col("block").alias("of_block"), "at", "c")
    names = [part.split()[0] for part in SCORES.split(", ")]

    def scored(block: pa.Table, counts: pa.Table) -> pa.Table:
        parts, n = [], model["n"]
        known = model["count"]
        for batch in block.combine_chunks().to_batches():
            for row, (_, size, _) in enumerate(_coded(batch, model["common"])):
                words_ = batch.column("words")[row].values.to_numpy().view(np.uint64)
                codes = _codes(words_, batch.column("shapes")[row].values.to_numpy(), model["common"])
                tokens = np.frombuffer(batch.column("tokens")[row].as_buffer(), np.int32)
                count = np.zeros(len(words_))
                count[counts.column("at").to_numpy()] = counts.column("c").to_numpy()
                common_ = codes < len(known)
                count[common_] = known[codes[common_]]
                own = model["classes"][codes]
                end = own == n - 1
                count[end] = model["mass"][-1] - ADDED
                single = np.log10((count + ADDED) / (model["total"] + ADDED * (model["distinct"] + 1)))
                emission = np.where(end, 0.0, np.log10((count + ADDED) / model["mass"][own]))
                at = np.concatenate([[0], np.cumsum(size)])
                whole = emission[tokens] + model["transition"].ravel()[_histories(own[tokens], size, n)]
                held = batch.column("held_out")[row].values
                parts.append(pa.table([
                    batch.column("doc_ids")[row].values, held, pa.array(size.astype(np.int64)),
                    pa.array(wordhash.sums(count[tokens] > 0.5, at)), pa.array(np.full(len(size), model["total"])),
                    pa.array(wordhash.sums(single[tokens], at, float)), pa.array(wordhash.sums(whole, at, float)),
                ], names))
        return pa.concat_tables(parts) if parts else pa.schema([]).empty_table()

    return blocks.drop("counts").groupBy("block").cogroup(rare.groupBy("of_block")).applyInArrow(scored, SCORES)
