"""Best-fit packing of token sequences with exact complements.

Documents become token ids and an end mark; a document over the capacity is cut into full pieces,
the first of which may be shorter. How pieces are combined depends on lengths alone, so the plan is
made from one count per length (at most ``capacity`` numbers, whatever the corpus): for each length,
longest first, single lengths, pairs and triples that fill its gap exactly are looked up and used as
often as the counts allow; what no combination completes goes to the fullest sequence with room.
The plan is a table of rank intervals per length; pieces are ranked by length in a range-partitioned
sort and find their sequence and place by their rank.

Defined cases: a null or empty text is just its end mark. Repeated rows are packed each. An empty
table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, functions as F

from loamsift.llm import wordhash
from loamsift.llm.common import text_of
from loamsift.operators.ranking import add_rank
from loamsift.operators.staging import stage

CAPACITY = 1024
END_ID = 2
# How the vocabulary's texts are split into pieces, and its one special token.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
CACHE_ENTRIES = 400_000


class _Ids:
    """Ids of whole batches of texts. What lies between two spaces is encoded once and then looked up.

    A space before anything but white space always begins a new piece, so texts may be taken apart
    there. Texts in which spaces stand next to other white space, or which name the special token,
    are encoded as a whole.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.sizes = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.known: dict[int, bytes] = {}

    def whole(self, text: str) -> bytes:
        if "<|" in text:
            return np.array(self.encoding.encode(text, allowed_special="all"), "<u4").tobytes()
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def _learn(self, keys: list[int], parts: list[bytes]) -> None:
        """Encode parts that each follow a space, in one go; they end where the sizes of their ids say."""
        joined = b" " + b" ".join(parts)
        ids = np.array(self.encoding.encode_ordinary(joined.decode()), "<u4")
        ends = np.cumsum([1 + len(part) for part in parts])
        at = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        raw, begin = ids.tobytes(), 0
        for key, end in zip(keys, at.tolist(), strict=True):
            self.known[key] = raw[4 * begin : 4 * end]
            begin = end

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        raw, offsets = wordhash.flat(texts)
        space = raw == 0x20
        begins, ends = wordhash.spans(~space, offsets)
        n, at = len(offsets) - 1, np.searchsorted(begins, offsets)
        first = np.zeros(len(begins), bool)
        first[np.searchsorted(begins, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
        # Whole texts: spaces beside spaces or at an end, parts that begin with white space, special tokens.
        odd = wordhash.sums(space, offsets) + 1 != np.diff(at)
        head, second = raw[begins], raw[np.minimum(begins + 1, max(0, len(raw) - 1))]
        blank = (head >= 9) & (head <= 13) | (head >= 28) & (head <= 31) | (head == 0xC2) & ((second == 0x85) | (second == 0xA0))
        blank |= (head == 0xE1) & (second == 0x9A) | (head == 0xE2) & ((second == 0x80) | (second == 0x81)) | (head == 0xE3) & (second == 0x80)
        odd |= wordhash.sums(blank & ~first, at) > 0
        odd |= np.asarray(pc.match_substring(pc.fill_null(texts, ""), "<|"))
        keys = wordhash.span_hashes(raw, begins, ends)
        keys[first] = wordhash.mixed(keys[first] + np.uint64(1))  # the same part without a space before it
        unique, where, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > CACHE_ENTRIES:
            self.known = {}
        keys = unique.tolist()
        new = np.array([k not in self.known for k in keys], bool)
        alone = new & (first[where] | np.repeat(odd, np.diff(at))[where])
        data, begin, end = raw.tobytes(), begins[where].tolist(), ends[where].tolist()
        for i in np.flatnonzero(alone).tolist():
            self.known[keys[i]] = self.whole(("" if first[where[i]] else " ") + data[begin[i] : end[i]].decode())
        if later := np.flatnonzero(new & ~alone).tolist():
            self._learn([keys[i] for i in later], [data[begin[i] : end[i]] for i in later])
        found = list(map(self.known.__getitem__, keys))
        sizes = np.array([len(x) for x in found], np.int64) // 4
        store, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[which]
        upto = np.cumsum(each)
        ids = store[np.repeat(starts[which] - (upto - each), each) + np.arange(upto[-1] if len(upto) else 0)]
        edges = np.concatenate([[0], upto])[at]
        for k in range(n):
            yield self.whole(texts[k].as_py() or "") if odd[k] else ids[edges[k] : edges[k + 1]].tobytes()


@functools.lru_cache(1)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def id_bits(vocabulary: str | None = None, end_id: int = END_ID) -> int:
    """16 if the largest id of the vocabulary fits, else 32."""
    with open(vocabulary or default_vocabulary(), "rb") as file:
        largest = max(end_id, *SPECIAL.values(), *(int(line.split()[1]) for line in file if line.strip()))
    return 16 if largest < 1 << 16 else 32


def tokenise(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, bits: int = 32
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids`` (little-endian numbers of 32 or 16 ``bits``)."""
    path = vocabulary or default_vocabulary()
    if bits not in (16, 32):
        raise ValueError("bits must be 16 or 32")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _ids(path).batch, np.array([end_id], "<u4").tobytes()
        for batch in (part for whole in batches for part in wordhash.slices(whole)):
            doc, piece, start, length, ids = [], [], [], [], []
            for doc_id, own in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                own += end
                total = len(own) // 4
                if bits == 16:  # two bytes are enough for up to 65,536 ids
                    own = np.frombuffer(own, "<u4").astype("<u2").tobytes()
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(doc_id), piece.append(number), start.append(a), length.append(b - a)
                    ids.append(own[bits // 8 * a : bits // 8 * b])
            columns = [pa.array(x, pa.int64()) for x in (doc, piece, start, length)]
            yield pa.record_batch([*columns, pa.array(ids, pa.binary())], names)

    names = ["doc_id", "piece", "start", "length", "ids"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(pieces, "doc_id bigint, piece bigint, start bigint, length bigint, ids binary")


class _Plan:
    """Patterns (lengths in a sequence) and how often each is used, from one count per length."""

    def __init__(self, counts: np.ndarray, capacity: int, parts: int):
        """``parts``: of how many lengths a complement may consist."""
        self.left, self.capacity, self.parts = counts.astype(np.int64), capacity, parts
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        for length in range(capacity, 0, -1):
            while self.left[length] and (rest := self._complement(length)) is not None:
                self._use((length, *rest))
        self._best_fit()

    def _times(self, pattern: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // pattern.count(x) for x in pattern)

    def _use(self, pattern: tuple[int, ...]) -> None:
        times = self._times(pattern)
        for length in pattern:
            self.left[length] -= times
        self.patterns.append((pattern, times))

    def _pair(self, first: int, gap: int, third: int = 0) -> tuple[int, ...] | None:
        """Two lengths that fill ``gap`` beside ``first`` (and ``third``), the longer one as long as can be."""
        longer = np.arange(min(gap - 1, first), (gap - 1) // 2, -1)
        for x in longer[(self.left[longer] > 0) & (self.left[gap - longer] > 0)]:
            rest = (int(x), int(gap - x), *([third] if third else []))
            if self._times((first, *rest)):
                return rest
        return None

    def _complement(self, length: int) -> tuple[int, ...] | None:
        gap = self.capacity - length
        if gap == 0:
            return ()
        if self.parts >= 1 and gap <= length and self.left[gap] and self._times((length, gap)):
            return (gap,)
        if self.parts >= 2 and (pair := self._pair(length, gap)) is not None:
            return pair
        for third in np.flatnonzero(self.left[: gap // 3 + 1])[::-1] if self.parts >= 3 else ():
            if (pair := self._pair(length, gap - int(third), int(third))) is not None:
                return pair
        return None

    def _best_fit(self) -> None:
        room: dict[int, list[tuple[tuple[int, ...], int]]] = {0: []}  # gap: open patterns and their numbers
        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            while n:
                gap = min((g for g, found in room.items() if found and g >= length), default=0)
                if gap:
                    pattern, bins = room[gap].pop()
                else:
                    pattern, bins, gap = (), -(-n // (self.capacity // length)), self.capacity
                each = min(n, gap // length)
                used = min(bins, n // each)
                if gap < self.capacity and bins > used:
                    room[gap].append((pattern, bins - used))
                room.setdefault(gap - each * length, []).append((pattern + (length,) * each, used))
                n -= each * used
        self.patterns += [found for groups in room.values() for found in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The plan with the fewest sequences: complements of up to three, two, one or no lengths come first.

    Triples can use up the short pieces that best fit needs for other gaps, so fewer may be better.
    """
    array = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        array[length] = n
    plans = [_Plan(array, capacity, parts).patterns for parts in (3, 2, 1, 0)]
    return min(plans, key=lambda patterns: sum(times for _, times in patterns))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with ``length`` and a unique ``_piece``) with ``sequence_id`` and ``offset``."""
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, firsts, each, sequences, offsets = [], [], [], [], []
    used, first_sequence = dict.fromkeys(counts, 0), 0
    for pattern, times in plan(counts, capacity):
        at = 0
        for length in sorted(set(pattern), reverse=True):
            many = pattern.count(length)
            keys.append(length), firsts.append(used[length]), each.append(many)
            sequences.append(first_sequence), offsets.append(at)
            used[length] += many * times
            at += many * length
        first_sequence += times
    order = np.lexsort((firsts, keys))
    keys, firsts, each, sequences, offsets = (np.array(x, np.int64)[order] for x in (keys, firsts, each, sequences, offsets))
    lengths = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        lengths[length + 1] = n
    start_of = np.cumsum(lengths)  # rank of the first piece of each length
    first_rank = start_of[keys] + firsts
    ranked = add_rank(pieces, [F.col("length"), F.col("_piece")], "_rank")
    names = [name for name in pieces.columns if name.lower() not in ("sequence_id", "offset", "_piece")] + ["_piece"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column("_rank").to_numpy(), batch.column("length").to_numpy()
            at = np.searchsorted(first_rank, rank, "right") - 1
            turn = rank - first_rank[at]
            sequence = pa.array(sequences[at] + turn // each[at])
            offset = pa.array(offsets[at] + turn % each[at] * length)
            yield pa.record_batch([*[batch.column(name) for name in names], sequence, offset], [*names, "sequence_id", "offset"])

    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in names) + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def numbered(pieces: DataFrame, name: str) -> DataFrame:
    """Write the pieces with a number of their own."""
    return stage(pieces.withColumn("_piece", F.monotonically_increasing_id()), name)


def packed_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece with its ids (16 bits each if all fit, else 32): ``doc_id, piece, start, length, sequence_id, offset, ids``."""
    pieces = numbered(tokenise(docs, vocabulary, capacity, bits=id_bits(vocabulary)), "op9_ids")
    placed = pack(pieces.drop("ids"), capacity)
    return placed.join(pieces.select("_piece", "ids"), "_piece").drop("_piece")
