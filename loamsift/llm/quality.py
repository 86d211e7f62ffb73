"""Quality rules: a hashed n-gram logistic regression, calibrated, behind two base rules.

Features are counts of word 1- and 2-grams and of 4-grams of UTF-8 units, each hashed into its own
half of the weights and divided by the text's number of them. The model is fitted on at most
``max_rows`` labelled rows, chosen by the hash of their id; gradients are summed by Spark, one
vector per task, so the driver only ever holds vectors of the model's size. A fifth of those rows
is held out for the two numbers of a Platt calibration. Every document is then scored in Arrow
batches against fixed thresholds; n-grams are hashed for a whole batch at a time.

Defined cases: a null or empty text has no words and fails the base rule. Labels without id or
quality are not used; a document labelled twice counts with each label. With no labels of either
kind there is no model and the base rules decide alone (probability null). An empty table gives no
rows. Other columns play no part, and ``good_documents`` hands them on unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loamsift.llm import wordhash
from loamsift.llm.common import text_of
from loamsift.operators.staging import stage

MAX_ROWS = 6_000
SAMPLE_FILES = 8
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HALF_BITS = 16
HALF = 1 << HALF_BITS
SCALE = 16.0  # features are frequencies times this
PENALTY = 1e-4
ROUNDS = 25
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _index(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - HALF_BITS)).astype(np.int64)


def _features(raw: np.ndarray, offsets: np.ndarray, word: np.ndarray, at: np.ndarray):
    """Hashed word n-grams and unit n-grams of a batch: (index, offsets of each text) for either."""
    pairs = wordhash.runs_of(word, 2)
    inside = np.ones(len(pairs), bool)
    ends = at[1:-1]
    inside[ends[(ends > 0) & (ends <= len(pairs))] - 1] = False  # no pair reaches from one text into the next
    place = np.flatnonzero(inside)
    words = np.concatenate([_index(word), _index(pairs[place])])
    n_words, n_pairs = np.diff(at), np.diff(np.searchsorted(place, at))
    units = raw.astype(np.uint32)
    n = max(0, len(raw) - 3)
    grams = units[:n] | units[1 : n + 1] << np.uint32(8) | units[2 : n + 2] << np.uint32(16) | units[3 : n + 3] << np.uint32(24)
    grams = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - HALF_BITS)).astype(np.int64) + HALF
    # 4-grams that reach into the next text stay out: each text gives the first ``size - 3`` of its own.
    first = np.minimum(offsets[:-1], n)
    last = np.maximum(first, np.minimum(offsets[1:] - 3, n))
    return words, n_words, n_pairs, grams, first, last


def _logits(model: dict, raw, offsets, word, at) -> np.ndarray:
    weights = model["weights"]
    words, n_words, n_pairs, grams, first, last = _features(raw, offsets, word, at)
    ones, pairs = weights[words[: len(word)]], weights[words[len(word) :]]
    total = wordhash.sums(ones, at, float) + wordhash.sums(pairs, np.concatenate([[0], np.cumsum(n_pairs)]), float)
    chars = np.concatenate([[0.0], np.cumsum(weights[grams], dtype=float)])
    return model["bias"] + SCALE * (
        total / np.maximum(1, n_words + n_pairs) + (chars[last] - chars[first]) / np.maximum(1, last - first)
    )


def _base(raw, offsets, begins, word, at) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(offsets) - 1
    inside = wordhash.is_word(raw)
    chars = wordhash.sums(inside & ((raw & 0xC0) != 0x80), offsets)
    symbols = wordhash.sums(_SYMBOL[raw], offsets)
    begin, end = wordhash.spans(raw != 10, offsets)
    filled = np.searchsorted(begins, end) > np.searchsorted(begins, begin)
    begin, end = begin[filled], end[filled]
    line, text = wordhash.span_hashes(raw, begin, end), np.searchsorted(offsets, begin, "right") - 1
    order = np.lexsort((line, text))
    again = (line[order][1:] == line[order][:-1]) & (text[order][1:] == text[order][:-1])
    dup_lines = np.bincount(text[order][1:][again], minlength=n)
    owner = np.repeat(np.arange(n), np.diff(at))
    windows = np.flatnonzero(owner[2:] == owner[:-2]) if len(word) > 2 else np.zeros(0, np.int64)
    key = wordhash.mixed(wordhash.runs_of(word, 3)[windows] + owner[windows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[windows[twice] + k] = True
    return [np.diff(at), chars, symbols, dup_lines, wordhash.sums(covered, at)]


def _scored(batch: pa.RecordBatch, column: str, model: dict | None) -> list[np.ndarray]:
    raw, offsets = wordhash.flat(batch.column(column))
    begins, ends = wordhash.words(raw, offsets)
    word, at = wordhash.span_hashes(raw, begins, ends), np.searchsorted(begins, offsets)
    base = _base(raw, offsets, begins, word, at)
    failed = (base[0] < MIN_WORDS) | (100 * base[4] > MAX_REPEAT_PERCENT * base[0])
    if model is None:
        return [*base, failed, np.full(len(failed), np.nan), ~failed]
    chance = 1 / (1 + np.exp(-(model["slope"] * _logits(model, raw, offsets, word, at) + model["shift"])))
    return [*base, failed, chance, ~failed & (chance >= model["threshold"])]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Hashed features of the sample: ``label, held_out, index, value``."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    rows = usable.count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    # Fewer than max_rows are expected, then cut: the sample is small enough to be broadcast.
    sample = F.broadcast(usable.where(draw < int((1 << 30) * min(1.0, max_rows / max(1, rows)))).limit(2 * max_rows))
    texts = docs.select("doc_id", text_of().alias("text")).join(sample, "doc_id").select(
        "text", "label", (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)) == 0).alias("held_out")
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch):
                raw, offsets = wordhash.flat(part.column("text"))
                begins, ends = wordhash.words(raw, offsets)
                word, at = wordhash.span_hashes(raw, begins, ends), np.searchsorted(begins, offsets)
                words, n_words, n_pairs, grams, first, last = _features(raw, offsets, word, at)
                pair_at = len(word) + np.concatenate([[0], np.cumsum(n_pairs)])
                index, value = [], []
                for k in range(len(n_words)):
                    own = np.concatenate([words[at[k] : at[k + 1]], words[pair_at[k] : pair_at[k + 1]]])
                    i, c = np.unique(own, return_counts=True)
                    j, d = np.unique(grams[first[k] : last[k]], return_counts=True)
                    index.append(np.concatenate([i, j]).astype(np.int32))
                    value.append((SCALE * np.concatenate([c / max(1, len(own)), d / max(1, last[k] - first[k])])).astype(np.float32))
                yield pa.record_batch(
                    [part.column("label"), part.column("held_out"), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                    ["label", "held_out", "index", "value"],
                )

    return texts.mapInArrow(features, "label int, held_out boolean, index array<int>, value array<float>")


def _matrix(batch: pa.RecordBatch):
    index, value = batch.column("index"), batch.column("value")
    at = np.asarray(index.offsets, np.int64)
    return index.flatten().to_numpy(), value.flatten().to_numpy(), at - at[0], np.asarray(batch.column("label"), float)


def _gradient(sample: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and gradient at ``weights`` (the last one is the bias): one vector per task comes back."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, rows = 0.0, np.zeros(2 * HALF + 1), 0
        for batch in batches:
            index, value, at, label = _matrix(batch)
            rows += len(label)
            logit = weights[-1] + wordhash.sums(weights[index] * value, at, float)
            loss += float(np.sum(np.logaddexp(0, logit) - label * logit))
            error = 1 / (1 + np.exp(-logit)) - label
            slope[:-1] += np.bincount(index, np.repeat(error, np.diff(at)) * value, 2 * HALF)
            slope[-1] += error.sum()
        if rows:
            yield pa.record_batch([pa.array([loss]), pa.array([slope.tobytes()], pa.binary())], ["loss", "slope"])

    total, slope = 0.0, np.zeros(2 * HALF + 1)
    for row in sample.mapInArrow(part, "loss double, slope binary").collect():  # a row per file of the sample
        total += row["loss"]
        slope += np.frombuffer(row["slope"])
    return total, slope


def _minimise(evaluate, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, slope = evaluate(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        direction, factors = -slope, []
        for s, y in reversed(past):
            a = s @ direction / (s @ y)
            direction = direction - a * y
            factors.append(a)
        if past:
            s, y = past[-1]
            direction = direction * (s @ y / (y @ y))
        for (s, y), a in zip(past, reversed(factors), strict=True):
            direction = direction + (a - y @ direction / (s @ y)) * s
        step = 1.0 if past else 1.0 / max(1e-12, np.linalg.norm(slope))
        for _ in range(6):
            there, new_slope = evaluate(x + step * direction)
            if there <= value + 1e-4 * step * (slope @ direction):
                break
            step /= 2
        else:
            return x
        s, y = step * direction, new_slope - slope
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        if value - there < 1e-4 * abs(value):
            return x + s
        x, value, slope = x + s, there, new_slope
    return x


def _calibrated(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift by Newton steps, on smoothed labels."""
    high, low = (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2)
    target, x = np.where(label > 0, high, low), np.array([1.0, 0.0])
    columns = np.stack([logit, np.ones_like(logit)], 1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(columns @ x, -30, 30)))
        slope = columns.T @ (chance - target) + [1e-3 * (x[0] - 1), 0]
        curve = (columns * (chance * (1 - chance))[:, None]).T @ columns + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        x = x - step
        if np.abs(step).max() < 1e-6:
            break
    return (float(x[0]), float(x[1])) if x[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> dict | None:
    """Weights, bias and calibration; None if the labels hold fewer than two kinds."""
    # In few files, whatever the scan's splits: each step of the descent takes a vector from every one.
    sample = stage(labelled_sample(docs, labels, max_rows).repartition(SAMPLE_FILES), "op5_sample")
    training = sample.where("NOT held_out").select("label", "index", "value")
    kinds = {row["label"]: row["count"] for row in training.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return None
    rows = sum(kinds.values())

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope = _gradient(training, x)
        penalty = np.append(np.full(2 * HALF, PENALTY), 0)
        return loss / rows + 0.5 * float(penalty @ (x * x)), slope / rows + penalty * x

    x = _minimise(evaluate, np.zeros(2 * HALF + 1), ROUNDS)
    model = {"weights": x[:-1].astype(np.float32), "bias": float(x[-1]), "slope": 1.0, "shift": 0.0, "threshold": threshold}

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value, at, label = _matrix(batch)
            logit = x[-1] + wordhash.sums(x[index] * value, at, float)
            yield pa.record_batch([pa.array(logit), pa.array(label)], ["logit", "label"])

    rows = sample.where("held_out").select("label", "index", "value").mapInArrow(held_out, "logit double, label double").collect()
    logit, label = np.array([row[0] for row in rows]), np.array([row[1] for row in rows])
    if len(set(label)) == 2:
        model["slope"], model["shift"] = _calibrated(logit, label)
    return model


SCORE_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"]


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """A row per document: ``doc_id``, the base counts, ``base_failed``, ``probability`` and ``kept``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch):
                found = _scored(part, "text", model)
                chance = pa.array(found[6], mask=np.isnan(found[6]))
                yield pa.record_batch(
                    [part.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in found[:5]], pa.array(found[5]), chance, pa.array(found[7])],
                    ["doc_id", *SCORE_NAMES],
                )

    schema = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, probability double, kept boolean"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(scored, schema)


def good_documents(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs``, all columns, that base rules and model keep."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch):
                yield part.filter(pa.array(_scored(part, "text", model)[7]))

    return docs.mapInArrow(kept, docs.schema)
