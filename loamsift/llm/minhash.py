"""Near duplicates by HyperMinHash sketches: banded, estimated, then confirmed on full sets.

A document is its set of distinct 5-word shingles. One hash per shingle fills one of 64 registers,
which keeps the leading-zero count and ten further bits of the smallest hash of its part. Three
neighbouring registers make a band; documents that share a band are candidates. At a similarity
of 0.75 two documents share one of the 21 bands but for one pair in 100,000. Very small sets fill few
bands and would be missed more often, so a set of up to ``SMALL`` shingles is also linked to what it is without
one of them: with up to five shingles in the smaller set no other sets are similar enough.

Copies of a set are one node. The first scan writes bands only; the registers and full sets of nodes that
share a bucket are made anew in a second scan of their documents. Within a bucket every node is first compared with the smallest one
only: a group of near copies costs a comparison per copy and band. The similarity that the registers
estimate, less the matches expected by chance, sorts out hopeless pairs; the others are confirmed on
full sets, for each node the likeliest first, so that most pairs turn out to be linked already. Only
buckets that still hold several components are then looked through for further links, in blocks of
bounded size; nothing is compared within a component, and no pairs are written but links.

Defined cases: texts without words have an empty set and no links. Fewer than five words are one
shingle. A document without id takes part, but a component takes its smallest id that is there. Rows
that repeat an id and text share their verdict. An empty table gives no rows. Other columns play no
part, and ``representatives`` hands them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loamsift.llm import wordhash
from loamsift.llm.common import boxed, small_side, text_of
from loamsift.llm.components import components
from loamsift.operators.staging import stage

SHINGLE = 5
PERCENT = 75
REGISTERS = 64
BAND = 3
BITS = 10
BLOCK = 2048  # nodes of one bucket that are compared in one go
SMALL = 8  # shingles up to which a set looks for the sets with one shingle less
FEW = 8  # sets that are intersected one by one
LARGE = 8_000_000  # shingles of a block beyond which all are
MARGIN = 4.5  # standard deviations by which an estimate may fall short
# Fixed value: the share of chance matches between registers with one further bit.
CHANCE = 0.16991948

SKETCH = "doc_id bigint, _text_hash bigint, n_shingles bigint, node bigint, bands array<bigint>, smaller array<bigint>, registers binary, shingles binary"
NARROW = ["doc_id", "_text_hash", "n_shingles", "node", "bands", "smaller"]


def _sets(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    runs, found = wordhash.runs_of(words, SHINGLE), []
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        n = end - begin
        if n >= SHINGLE:
            found.append(np.unique(runs[begin : end - SHINGLE + 1]))
        elif n:
            found.append(wordhash.runs_of(words[begin:end], n) + np.uint64(n))
        else:
            found.append(words[:0])
    return found


def _registers(flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Registers (n x 64; 0 if empty) of sorted sets that lie one after the other."""
    part = owner * REGISTERS + (flat >> np.uint64(58)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    rest = flat[first] & np.uint64((1 << 58) - 1)
    width = np.frexp(rest.astype(float))[1]  # bits that are left after the leading zeros
    low = (rest << np.uint64(BITS)) >> np.maximum(0, width - 1).astype(np.uint64)
    out = np.zeros(n * REGISTERS, np.uint16)
    out[part[first]] = ((58 - width) << BITS | (low & np.uint64((1 << BITS) - 1)).astype(np.int64)) + 1
    return out.reshape(n, REGISTERS)


def _bands(registers: np.ndarray) -> list[np.ndarray]:
    """Keys of the bands of each text that have a filled register."""
    n = REGISTERS // BAND
    parts = registers[:, : n * BAND].reshape(-1, n, BAND).astype(np.uint64)
    keys = np.arange(n, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(BAND):
        keys = wordhash.mixed(keys * np.uint64(1 << 16) + parts[:, :, k])
    filled = parts.any(axis=2)
    return [key[use].view(np.int64) for key, use in zip(keys, filled)]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SKETCH.split(", ")]
    for batch in batches:
        for part in wordhash.slices(batch):
            words, at = wordhash.text_words(part.column("text"), lower=True)
            sets = _sets(words, at)
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate([*sets, words[:0]])
            registers = _registers(flat, np.repeat(np.arange(len(sets)), sizes), len(sets))
            edges = np.concatenate([[0], np.cumsum(sizes)])
            each = wordhash.mixed(flat + np.uint64(1))
            total = wordhash.sums(each, edges, np.uint64) + sizes.astype(np.uint64)
            node = wordhash.mixed(total).view(np.int64)
            # The nodes of the set without one shingle: similar enough from four shingles on.
            smaller = [
                wordhash.mixed(total[i] - each[edges[i] : edges[i + 1]] - np.uint64(1)).view(np.int64) if 100 * (n - 1) >= PERCENT * n and n <= SMALL else node[:0]
                for i, n in enumerate(sizes.tolist())
            ]
            yield pa.record_batch([
                part.column("doc_id"), part.column("_text_hash"), pa.array(sizes, pa.int64()), pa.array(node, mask=sizes == 0),
                pa.array(_bands(registers), pa.list_(pa.int64())), pa.array(smaller, pa.list_(pa.int64())), pa.array([r.tobytes() for r in registers], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), "text")


def sketches(docs: DataFrame) -> DataFrame:
    """Size, node and bands of every document (a written table). Sets are made anew for candidates only."""
    schema = ", ".join(part for part in SKETCH.split(", ") if part.split()[0] in NARROW)
    return stage(_texts(docs).mapInArrow(lambda batches: (b.select(NARROW) for b in _sketched(batches)), schema), "op3_sketches")


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard index of rows of registers, less chance matches, and its standard deviation at the limit."""
    filled = np.count_nonzero((a > 0) | (b > 0), axis=-1)
    equal = np.count_nonzero((a == b) & (a > 0), axis=-1)
    ratio = np.minimum(n_a, n_b) / np.maximum(1, np.maximum(n_a, n_b))
    chance = CHANCE * 2.0 ** (1 - BITS) * 4 * ratio / (1 + ratio) ** 2
    share = equal / np.maximum(1, filled)
    limit = PERCENT / 100
    return (share - chance) / (1 - chance), np.sqrt(limit * (1 - limit) / np.maximum(1, filled))


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _intersections(sets: list[np.ndarray]):
    """A function of a set's place and the places of others: the sizes of their intersections.

    The shingles of a block are numbered once, so that a set is marked and all the others count its
    marks at once. Where a few sets are asked for, or the sets are very large, each pair is intersected.
    """
    ends = np.cumsum([len(s) for s in sets])
    numbers: list[np.ndarray] = []

    def common(place: int, others: np.ndarray) -> np.ndarray:
        if len(others) < FEW or ends[-1] > LARGE:
            return np.array([len(np.intersect1d(sets[place], sets[j], assume_unique=True)) for j in others], np.int64)
        if not numbers:
            numbers.append(np.unique(np.concatenate(sets), return_inverse=True)[1])
        marks = np.zeros(int(numbers[0].max()) + 1, np.int32)
        marks[numbers[0][ends[place] - len(sets[place]) : ends[place]]] = 1
        return np.add.reduceat(marks[numbers[0]], ends - [len(s) for s in sets])[others]

    return common


def _array(column: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that may be similar enough, with the estimate."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.stack(_array(batch.column(name), np.uint16)) for name in ("ra", "rb"))
        n_a, n_b = (batch.column(name).to_numpy() for name in ("na", "nb"))
        found, deviation = similarity(a, b, n_a, n_b)
        use = (found + MARGIN * deviation >= PERCENT / 100) & (100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b))
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(found)], ["a", "b", "estimate"]).filter(pa.array(use))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        use = [_linked(x, y) for x, y in zip(_array(batch.column("sa"), np.uint64), _array(batch.column("sb"), np.uint64))]
        yield batch.select(["a", "b"]).filter(pa.array(use, pa.bool_()))


def _pairs_with(pairs: DataFrame, nodes: DataFrame, names: dict[str, str]) -> DataFrame:
    """``pairs`` with columns of both nodes: each named column, with the suffix of its side."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(n + side) for c, n in names.items()]), side)
    return pairs


def _confirm(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    both = _pairs_with(pairs.select("a", "b"), nodes, {"shingles": "s"})
    return both.select("a", "b", "sa", "sb").mapInArrow(_confirmed, "a bigint, b bigint")


def _relabelled(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after ``edges`` between nodes have been added."""
    if labels is None:
        return stage(components(edges), "op3_labels")
    merged = components(_across(edges, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    merged = stage(merged.select(F.col("node").alias("label"), F.col("label").alias("_to")), "op3_merged")
    old = labels.join(merged, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
    new = merged.join(labels, merged["label"] == labels["label"], "left_anti")  # nodes that had no label yet
    return stage(old.unionByName(new.select(F.col("label").alias("node"), F.col("_to").alias("label"))), "op3_labels")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet, with the labels of both ends."""
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("label").alias("l" + side))
        pairs = pairs.join(own, side, "left").withColumn("l" + side, F.coalesce("l" + side, side))
    return pairs.where("la <> lb")


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components within each block; rows come sorted by block."""

    def links(rows: pa.Table) -> list[tuple[int, int]]:
        node, component = rows.column("node").to_numpy(), rows.column("label").to_numpy().copy()
        size, own = rows.column("n_shingles").to_numpy(), rows.column("own").to_numpy(zero_copy_only=False)
        registers = np.stack(_array(rows.column("registers").combine_chunks(), np.uint16))
        sets, found = _array(rows.column("shingles").combine_chunks(), np.uint64), []
        both = _intersections(sets)
        for i in range(len(node) - 1):
            other = np.flatnonzero((component[i + 1 :] != component[i]) & ~(own[i] & own[i + 1 :])) + i + 1
            other = other[100 * np.minimum(size[other], size[i]) >= PERCENT * np.maximum(size[other], size[i])]
            if not len(other):
                continue
            estimate, deviation = similarity(registers[i][None, :], registers[other], size[i], size[other])
            other = other[estimate + MARGIN * deviation >= PERCENT / 100]
            common = both(i, other)
            for j in other[100 * common >= PERCENT * (size[i] + size[other] - common)].tolist():
                if component[j] != component[i]:
                    found.append((int(node[i]), int(node[j])))
                    component[component == component[j]] = component[i]
        return found

    kept: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        found = links(pa.Table.from_batches(kept)) if kept else []
        kept.clear()
        return pa.record_batch([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    last = None
    for batch in batches:
        block = np.stack([batch.column("key").to_numpy(), batch.column("block").to_numpy()], 1)
        cuts = np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            if begin == end:
                continue
            if last is not None and last != tuple(block[begin].tolist()):
                yield flush()
            last = tuple(block[begin].tolist())
            kept.append(batch.slice(begin, end - begin))
    yield flush()


def _blocks(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, block, node, label, own``: rows of buckets with several components, dealt to blocks.

    A bucket of up to ``BLOCK`` rows is one block. In a larger one the most frequent component (``own``) and
    the rest are dealt to chunks; each chunk of the first meets each of the rest, and these each other.
    """
    rows = crowded.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    rows = stage(rows, "op3_bucket_rows")
    kinds = rows.groupBy("key", "label").agg(F.count("*").alias("_n"))
    buckets = kinds.groupBy("key").agg(F.sum("_n").alias("_rows"), F.max(F.struct("_n", "label")).alias("_most"), F.count("*").alias("_kinds"))
    # Two rows have been compared already.
    buckets = buckets.where("_kinds > 1 AND _rows > 2").select("key", "_rows", F.col("_most._n").alias("_main"), F.col("_most.label").alias("_label"))
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(BLOCK // 2))).cast("bigint")
    dealt = rows.join(buckets, "key").withColumns({
        "own": F.col("label") == F.col("_label"), "_a": parts(F.col("_main")), "_b": parts(F.col("_rows") - F.col("_main")),
    })
    chunk = F.pmod(F.xxhash64("node"), F.when(F.col("own"), F.col("_a")).otherwise(F.col("_b")))
    zero, wide = F.lit(0).cast("bigint"), F.lit(1 << 31)
    own_blocks = F.transform(F.sequence(zero, F.col("_b") - 1), lambda j: F.col("_chunk") * wide + j)
    main_blocks = F.transform(F.sequence(zero, F.col("_a") - 1), lambda i: i * wide + F.col("_chunk"))
    rest_blocks = F.transform(
        F.sequence(zero, F.col("_b") - 1),
        lambda j: -1 - (F.least(j, F.col("_chunk")) * wide + F.greatest(j, F.col("_chunk"))),
    )
    blocks = (
        F.when(F.col("_rows") <= BLOCK, F.array(zero)).when(F.col("own"), own_blocks).otherwise(F.concat(main_blocks, rest_blocks))
    )
    return dealt.withColumn("_chunk", chunk).select("key", "node", "label", "own", F.explode(blocks).alias("block"))


def _candidates(docs: DataFrame, sketched: DataFrame, crowded: DataFrame) -> DataFrame:
    """``node, n_shingles, registers, shingles`` of the nodes in ``crowded``, each from one of its documents."""
    rows = sketched.select("node", "doc_id", "_text_hash").join(crowded.select("node").distinct(), "node", "left_semi")
    chosen = rows.groupBy("node").agg(F.min(F.struct("_text_hash", "doc_id")).alias("_row"))
    chosen = stage(chosen.select(F.col("_row.doc_id").alias("_doc"), F.col("_row._text_hash").alias("_hash")), "op3_chosen")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    again = _texts(docs).join(small_side(chosen), same, "left_semi").mapInArrow(_sketched, SKETCH)
    nodes = stage(again.select("node", "n_shingles", "registers", "shingles"), "op3_nodes")
    return nodes if nodes.count() == chosen.count() else stage(nodes.dropDuplicates(["node"]), "op3_nodes")  # repeated rows


def _small_links(sketched: DataFrame) -> DataFrame:
    """Links of small sets to sets that lack one of their shingles; a node says what is in a set, so none is compared."""
    found = sketched.select("n_shingles", F.col("node").alias("b"), F.explode("smaller").alias("a")).distinct()
    nodes = sketched.where(F.col("n_shingles").between(1, SMALL)).select((F.col("n_shingles") + 1).alias("n_shingles"), F.col("node").alias("a"))
    return found.join(nodes.distinct(), ["n_shingles", "a"]).select("a", "b")


def linked_components(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """``node, label`` of all nodes that are linked with another one."""
    # Copies of a set are one node: a bucket counts if it holds two different ones.
    bands = sketched.where("node IS NOT NULL").select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("_first"), F.max("node").alias("_last")).where("_first < _last").drop("_last")
    shared = stage(shared, "op3_shared")  # written, so that a key which very many rows have can be split in the join
    crowded = stage(bands.join(shared, "key").distinct(), "op3_crowded")
    nodes = _candidates(docs, sketched, crowded)
    stars = crowded.where("node <> _first").select(F.col("_first").alias("a"), F.col("node").alias("b")).distinct()
    likely = _pairs_with(stars, nodes, {"registers": "r", "n_shingles": "n"}).select("a", "b", "ra", "rb", "na", "nb")
    likely = stage(likely.mapInArrow(_estimated, "a bigint, b bigint, estimate double"), "op3_likely")
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a"))
    labels = _relabelled(None, stage(_confirm(best, nodes).unionByName(_small_links(sketched)), "op3_links"))
    labels = _relabelled(labels, stage(_confirm(_across(likely, labels), nodes), "op3_links"))
    blocks = _blocks(crowded.select("key", "node"), labels).join(nodes.select("node", "n_shingles", "registers", "shingles"), "node")
    blocks = blocks.repartition("key", "block").sortWithinPartitions("key", "block", "node")
    found = blocks.select("key", "block", "node", "label", "own", "n_shingles", "registers", "shingles").mapInArrow(_searched, "a bigint, b bigint")
    return _relabelled(labels, stage(found, "op3_links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id, _text_hash, n_shingles, component_id, kept``."""
    sketched = sketches(docs)
    labels = linked_components(docs, sketched)
    rows = sketched.select("doc_id", "_text_hash", "n_shingles", "node").join(labels, "node", "left")
    rows = stage(rows.select("doc_id", "_text_hash", "n_shingles", "node", F.coalesce("label", "node").alias("_component")), "op3_rows")
    least = rows.where("node IS NOT NULL").groupBy("_component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("_n"))
    least = stage(least, "op3_least")  # written, so that a large component can be split in the join
    grouped = rows.join(least.where("_n > 1"), "_component").select("doc_id", "_text_hash", "n_shingles", "component_id")
    single = rows.where("node IS NOT NULL").join(least.where("_n = 1").select("_component"), "_component", "left_semi")
    single = single.unionByName(rows.where("node IS NULL")).select("doc_id", "_text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(single).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, but for near duplicates of a document with a smaller id."""
    gone = stage(near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_doc"), F.col("_text_hash").alias("_hash")).distinct(), "op3_gone")
    hashed = boxed(docs, "doc_id", F.xxhash64(text_of()).alias("_text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    return hashed.join(gone.hint("shuffle_hash"), same, "left_anti").select("_row.*")
