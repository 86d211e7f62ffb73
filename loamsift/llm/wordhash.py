"""Words and spans of a batch of texts as numpy arrays: where they are, and 64-bit hashes of them.

A batch of texts lies in one Arrow buffer. Everything here works on that buffer at once, so no
Python object is made per word. Large buffers are hashed in steps of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 2 << 20  # texts are worked off in slices of about so many bytes
STEP = 1 << 21
# A multiplier that is odd, its inverse modulo 2^64, and the finaliser's constants.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over the whole number."""
    shift = np.uint64(33)
    h = (h ^ (h >> shift)) * _MIX[0]
    h = (h ^ (h >> shift)) * _MIX[1]
    return h ^ (h >> shift)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_BYTES`` of text; a longer text is alone in its slice."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    begin = 0
    while begin < len(sizes):
        end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), BATCH_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def flat(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none) in one array, and where each text begins and ends in it."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return (_LOWER[raw] if lower else raw), offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of ``inside``; a run ends with its text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = False
    after[begins[1:] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans(~_SPACE[raw], offsets)


def is_word(raw: np.ndarray) -> np.ndarray:
    return ~_SPACE[raw]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > STEP:
        return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, p, np.uint64)])) for p in (_P, _P_INVERSE))
    if not _powers:
        _powers[0] = tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(STEP, p, np.uint64)])) for p in (_P, _P_INVERSE))
    return _powers[0]


def span_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span. Spans are in order and don't overlap."""
    found, at = np.empty(len(begins), np.uint64), 0
    while at < len(begins):
        upto = max(at + 1, int(np.searchsorted(ends, begins[at] + STEP, "right")))
        low, high = int(begins[at]), int(ends[upto - 1])
        power, inverse = _power(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=total[1:])
        first = begins[at:upto] - low
        found[at:upto] = mixed((total[ends[at:upto] - low] - total[first]) * inverse[first])
        at = upto
    return found


def text_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, and where each text's words begin and end among them."""
    raw, offsets = flat(texts, lower)
    begins, ends = words(raw, offsets)
    return span_hashes(raw, begins, ends), np.searchsorted(begins, offsets)


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` neighbours; there are ``n - 1`` fewer than hashes."""
    total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        total = total * np.uint64(_P) + hashes[k : k + len(total)]
    return mixed(total)


def sums(values: np.ndarray, offsets: np.ndarray, kind=np.int64) -> np.ndarray:
    """Sum of the values of each text; 0 for one without any."""
    out, full = np.zeros(len(offsets) - 1, kind), offsets[:-1] < offsets[1:]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=kind)
    return out
