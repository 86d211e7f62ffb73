"""Conversations with a legal order of roles, by the cheapest edits.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an
assistant turn. Rows are kept (cost 0), given the role that is due (2), deleted (3), and empty turns
of the role that is due are inserted (2); blank and repeated rows have to be deleted, and a row whose
text breaks off costs 1 if it stays. Of the cheapest edits the first in ASCII order of their initials
(Delete, Insert, Keep, Rerole) is taken.

Rows are dealt out by conversation and sorted by turn within it. Each task streams its rows once:
what is left to pay after a row depends only on a vector of four numbers (one per state: nothing yet,
system, user, assistant), of which, less their minimum, few different ones occur. So a row is one
symbol in a byte, and going backwards a conversation's backpointers are one byte per row too: the
number of the vector behind it. They decide the edits on the way forward, when the rows are read
again. State is carried across Arrow batches; rows, symbols and backpointers of a long conversation
are spilled to temporary files of the task, which go with it, so memory is bounded whatever the
length. A conversation is one stream because its digest is; whether a row repeats an earlier one is
settled before, by aggregation and a join that Spark can split.

Defined cases: null roles and texts are read as one space. Null turns come first. Rows that share a
turn are in the order of role and text; of equal rows all but the first are repeated ones. Rows with
null ``conv_id`` are one conversation. Only the first letter of a role counts, and a role that begins
otherwise than system, user and assistant do can't stay. Empty tables give no rows. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loamsift.llm.common import SPACE_CHARS, small_side
from loamsift.operators.staging import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPILL_BYTES = 8 << 20  # of a conversation's rows in memory
CHUNK = 1 << 20  # symbols or backpointers in memory
ENDS = frozenset(".!?")
DUE = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}  # state: next state and role
GIVEN = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GONE = 12  # the symbol of a row that has to be deleted; others are 4 * truncated + initial
INITIALS = "sua"


class _Automaton:
    """Vectors of what is left to pay, and the edits that they decide."""

    def __init__(self):
        end = self._with_inserts([0, 10**6, 10**6, 0])
        self.vectors, self.numbers = [end], {end: 0}
        self.before: list[list[int]] = []  # vector behind a row, symbol: vector ahead of it
        self.edits: list[list[list[tuple[str, int]]]] = []  # vector behind, symbol, state: edits, next state
        for vector in self.vectors:  # grows while new vectors turn up
            rows = [self._row(vector, symbol) for symbol in range(GONE + 1)]
            self.before.append([self._number(ahead) for ahead, _ in rows])
            self.edits.append([edits for _, edits in rows])
        self.at_end = [self._to_end(state) for state in range(4)]

    def _number(self, vector: tuple[int, ...]) -> int:
        vector = tuple(x - min(vector) for x in vector)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector]

    @staticmethod
    def _with_inserts(costs: list[int]) -> tuple[int, ...]:
        for _ in range(4):
            costs = [min(costs[state], INSERT + costs[DUE[state][0]]) for state in range(4)]
        return tuple(costs)

    def _row(self, behind: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], list[tuple[str, int]]]:
        late, initial = (symbol >= 4) * TRUNCATED, INITIALS[symbol % 4 : symbol % 4 + 1]
        options: list[list[tuple[int, str, int]]] = []
        for state in range(4):
            own = [(DELETE + behind[state], "D", state)]
            if symbol != GONE:
                own.append((REROLE + late + behind[DUE[state][0]], "R", DUE[state][0]))
                if initial and (state, initial) in GIVEN:
                    own.append((KEEP + late + behind[GIVEN[state, initial]], "K", GIVEN[state, initial]))
            options.append(own)
        ahead = self._with_inserts([min(own)[0] for own in options])
        edits = []
        for state in range(4):
            piece = ""
            while True:
                best = [(edit, after) for cost, edit, after in options[state] if cost == ahead[state]]
                if INSERT + ahead[DUE[state][0]] == ahead[state]:
                    best.append(("I", DUE[state][0]))
                edit, state = min(best)
                piece += edit
                if edit != "I":
                    break
            edits.append((piece, state))
        return ahead, edits

    @staticmethod
    def _to_end(state: int) -> str:
        piece = ""
        while state not in (0, 3):
            piece, state = piece + "I", DUE[state][0]
        return piece


@functools.lru_cache(1)
def automaton() -> _Automaton:
    return _Automaton()


class _Bytes:
    """A string of bytes in chunks, in a temporary file once there are several."""

    def __init__(self):
        self.last, self.chunks, self.file = bytearray(), 0, None

    def append(self, value: int) -> None:
        self.last.append(value)
        if len(self.last) == CHUNK:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.last)
            self.last, self.chunks = bytearray(), self.chunks + 1

    def chunk(self, number: int) -> bytes:
        if number == self.chunks:
            return bytes(self.last)
        self.file.seek(number * CHUNK)
        return self.file.read(CHUNK)


class _Rows:
    """Rows in order, in memory up to ``SPILL_BYTES`` and in a temporary file beyond."""

    def __init__(self):
        self.held, self.size, self.file = [], 0, None

    def append(self, row: tuple, size: int) -> None:
        self.held.append(row)
        self.size += size + 100
        if self.size > SPILL_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.held, self.file)
            self.held, self.size = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.held


class _Conversation:
    """The rows of one conversation as they come, then its edits."""

    def __init__(self, key: str):
        self.key, self.rows, self.symbols = key, _Rows(), _Bytes()
        self.first = self.turn = self.before = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: str, role: str, text: str, repeated: bool) -> None:
        inner = text.rstrip(SPACE_CHARS)
        same = (turn, role, text)
        fault = ""
        if not inner:
            fault = "blank"
        elif repeated or same == self.before:
            fault = "duplicate"
        elif inner[-1] not in ENDS:
            fault = "truncated"
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn and turn != self.turn:
            self.first, self.turn, self.turns = self.first or turn, turn, self.turns + 1
        self.before = same
        initial = INITIALS.find(role[:1]) if role else -1
        self.symbols.append(GONE if fault in ("blank", "duplicate") else 4 * (fault == "truncated") + (3 if initial < 0 else initial))
        self.rows.append((turn, role, text, fault), len(role) + len(text))

    def gaps(self) -> int:
        return int(self.turn) - int(self.first) + 1 - self.turns if self.turns else 0

    def _backpointers(self) -> Iterator[tuple[int, int]]:
        """(symbol, vector behind it) of every row in order; the vectors are found from the end."""
        vector, before, found = 0, automaton().before, _Bytes()
        stored = tempfile.TemporaryFile() if self.symbols.chunks else None
        for number in reversed(range(self.symbols.chunks + 1)):
            symbols = self.symbols.chunk(number)
            found = bytearray(len(symbols))
            for i in range(len(symbols) - 1, -1, -1):
                found[i] = vector
                vector = before[vector][symbols[i]]
            if stored:
                stored.seek(number * CHUNK)
                stored.write(found)
        for number in range(self.symbols.chunks + 1):
            if stored:
                stored.seek(number * CHUNK)
                found = stored.read(CHUNK)
            yield from zip(self.symbols.chunk(number), found)

    def edits(self) -> Iterator[tuple[str, str, str, str, str]]:
        """(edit, role, text, fault, turn) in order."""
        table, state = automaton().edits, 0
        for (turn, role, text, fault), (symbol, vector) in zip(self.rows, self._backpointers(), strict=True):
            piece, after = table[vector][symbol][state]
            for _ in piece[:-1]:
                state, due = DUE[state]
                yield "I", due, "", "", ""
            yield piece[-1], DUE[state][1] if piece[-1] == "R" else role, text, fault, turn
            state = after
        for _ in automaton().at_end[state]:
            state, due = DUE[state]
            yield "I", due, "", "", ""


def _conversations(frames: Iterable[pd.DataFrame]) -> Iterator[_Conversation]:
    """Whole conversations from sorted frames; one may go on over many frames."""
    now = None
    for frame in frames:
        for key, turn, role, text, repeated in zip(*(frame[name].tolist() for name in ("_conv", "_turn", "_role", "_text", "_repeated"))):
            if now is None or key != now.key:
                if now is not None:
                    yield now
                now = _Conversation(key)
            now.add(turn, role, text, repeated)
    if now is not None:
        yield now


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Working columns without nulls, by conversation and turn; ``_repeated``: role and text stand in an earlier turn."""
    turn = F.col("turn").cast("bigint")
    own = rows.select(
        F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")).alias("_conv"), turn.alias("_number"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("_role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("_text"),
    )
    place = F.struct(F.col("_number").isNotNull().alias("known"), "_number")
    key = F.md5(F.concat_ws(":", F.length("_role").cast("string"), "_role", "_text"))
    own = own.withColumn("_key", key)
    places = own.groupBy("_conv", "_key").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    again = stage(places.where("_first < _last").select("_conv", "_key", "_first"), "op11_again")
    marked = own.join(small_side(again), ["_conv", "_key"], "left")
    columns = [
        "_conv", F.coalesce(F.col("_number").cast("string"), F.lit("")).alias("_turn"), "_role", "_text",
        F.coalesce(place > F.col("_first"), F.lit(False)).alias("_repeated"), "_number",
    ]
    order = [F.col("_number").asc_nulls_first(), F.col("_role"), F.col("_text")]
    return marked.select(*columns).repartition("_conv").sortWithinPartitions("_conv", *order).drop("_number")


def _conv_id(rows: DataFrame) -> Column:
    return F.when(F.col("_conv") != "n", F.expr("substring(_conv, 2)")).cast(rows.schema["conv_id"].dataType).alias("conv_id")


def edits(rows: DataFrame) -> DataFrame:
    """Every edit: ``conv_id, place`` (from 0), ``edit`` (initial), ``role, text, fault, turn``.

    The repaired conversation is the rows whose ``edit`` isn't D. Inserted rows have no turn.
    """

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for conversation in _conversations(frames):
            for place, edit in enumerate(conversation.edits()):
                held.append((conversation.key, place, *edit))
                size += len(edit[2]) + 100
                if size > SPILL_BYTES:
                    yield pd.DataFrame(held, columns=names)
                    held, size = [], 0
        yield pd.DataFrame(held, columns=names)

    names = ["_conv", "place", "edit", "role", "text", "fault", "turn"]
    found = _sorted_rows(rows).mapInPandas(listed, "_conv string, place bigint, edit string, role string, text string, fault string, turn string")
    return found.select(
        _conv_id(rows), "place", "edit", "role", "text", F.expr("nullif(fault, '')").alias("fault"),
        F.expr("CAST(nullif(turn, '') AS BIGINT)").alias("turn"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, turn`` (anew, from 0), ``role, text, inserted``."""

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for conversation in _conversations(frames):
            turn = 0
            for edit, role, text, _, _ in conversation.edits():
                if edit == "D":
                    continue
                held.append((conversation.key, turn, role, text, edit == "I"))
                turn, size = turn + 1, size + len(text) + 100
                if size > SPILL_BYTES:
                    yield pd.DataFrame(held, columns=names)
                    held, size = [], 0
        yield pd.DataFrame(held, columns=names)

    names = ["_conv", "turn", "role", "text", "inserted"]
    found = _sorted_rows(rows).mapInPandas(numbered, "_conv string, turn bigint, role string, text string, inserted boolean")
    return found.select(_conv_id(rows), *names[1:])


def report(rows: DataFrame) -> DataFrame:
    """A row per conversation: faults, what its repair costs, the edits' initials and a digest of the result."""

    def told(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for conversation in _conversations(frames):
            audit, cost, digest, empty = [], 0, hashlib.sha256(), True
            for edit, role, text, fault, _ in conversation.edits():
                audit.append(edit)
                cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": KEEP}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if edit != "D":
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            counts = conversation.faults
            held.append((
                conversation.key, conversation.gaps(), counts["blank"], counts["duplicate"], counts["truncated"], conversation.illegal,
                cost, "".join(audit), digest.hexdigest(),
            ))
            size += len(audit) + 300
            if size > SPILL_BYTES:
                yield pd.DataFrame(held, columns=names)
                held, size = [], 0
        yield pd.DataFrame(held, columns=names)

    names = ["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = ["string", *["bigint"] * 6, "string", "string"]
    found = _sorted_rows(rows).mapInPandas(told, ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds)))
    return found.select(_conv_id(rows), *names[1:])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults made by the checksum of their id and turn: lost, emptied, cut, doubled or given to the user."""
    blank = F.lit(" ")
    fate = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), blank) for name in ("conv_id", "turn")))) % 20
    text, role = (F.coalesce(F.col(name).cast("string"), blank) for name in ("text", "role"))
    own = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("_fate")).where("_fate <> 0")
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")
