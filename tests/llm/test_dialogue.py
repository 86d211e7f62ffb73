"""Repair of conversations against trying all edits."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL

from loamsift.llm import dialogue
from loamsift.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def symbols(rows):
    """Fault of each (turn, role, text) row, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        inner = text.rstrip(SPACE)
        fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit, repaired) over all edits with up to two turns put in at each place."""
    faults, best = symbols(rows), None
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    own = []
    for (_, role, text), fault in zip(rows, faults):
        choices = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            choices += [("K", late, (role, text)), ("R", 2 + late, ("user", text)), ("R", 2 + late, ("assistant", text))]
        own.append([(*c, i) for c in choices for i in inserts])
    for chosen in itertools.product(*own):
        for last in inserts:
            audit, cost, out = "", 2 * len(last), []
            for edit, price, kept, before in chosen:
                audit, cost, out = audit + "I" * len(before) + edit, cost + price + 2 * len(before), out + [(r, "") for r in before]
                out += [kept] if kept else []
            out += [(r, "") for r in last]
            if LEGAL.fullmatch("".join(r[:1] for r, _ in out)) and (best is None or (cost, audit + "I" * len(last)) < best[:2]):
                names = {"u": "user", "a": "assistant"}
                best = (cost, audit + "I" * len(last), "\n".join(f"{r if t else names.get(r, r)}:{t}" for r, t in out))
    return best


def table(spark, conversations):
    rows = [(c, *row) for c, own in conversations.items() for row in own]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_cheapest_edits_against_all_edits(spark):
    draw, conversations = np.random.default_rng(4), {}
    for number in range(60):
        rows = []
        for turn in range(draw.integers(1, 4)):
            role = ["system", "user", "assistant", "tool"][draw.choice(4, p=[0.2, 0.35, 0.35, 0.1])]
            rows.append((turn, role, ["Yes.", f"t{turn}!", "cut off", " \n", f"other {turn}?"][draw.integers(0, 5)]))
        conversations[number] = rows
    found = {r.conv_id: r for r in dialogue.report(table(spark, conversations)).collect()}
    for number, rows in conversations.items():
        r, (cost, audit, text) = found[number], cheapest(rows)
        assert (r.cost, r.audit) == (cost, audit), rows
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest(), rows
        faults = symbols(rows)
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(x) for x in ("blank", "duplicate", "truncated"))
        assert r.illegal == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def test_repaired_rows_and_edits_agree_with_the_report(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    broken = dialogue.damaged(rows)
    report = {r.conv_id: r for r in dialogue.report(broken).collect()}
    edits, texts = {}, {}
    for r in dialogue.edits(broken).orderBy("conv_id", "place").collect():
        edits[r.conv_id] = edits.get(r.conv_id, "") + r.edit
        assert r.edit != "I" or (r.turn is None and r.text == "")
    for r in dialogue.repaired(broken).orderBy("conv_id", "turn").collect():
        texts.setdefault(r.conv_id, []).append((r.turn, f"{r.role}:{r.text}"))
    assert edits == {k: r.audit for k, r in report.items()}
    for key, r in report.items():
        own = texts.get(key, [])
        assert [t for t, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == r.repaired_sha256
    assert dialogue.report(dialogue.repaired(broken)).where("illegal > 0 or duplicate > 0").count() <= len(report)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(5)] + [(None, 1, None, None), (3, None, "user", "x.")]
    got = {}
    for r in dialogue.damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: None, 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(fate, [(role, text)])
        assert got.get((c, t)) == want


def test_giant_conversation_is_spilled_and_right(spark, monkeypatch):
    """Small bounds and a plain list of all rows give the same result as memory alone."""
    draw = np.random.default_rng(9)
    rows = [
        (t, ["user", "assistant", "system"][draw.choice(3, p=[0.5, 0.48, 0.02])], ["Same.", f"text {t}.", f"cut {t}", ""][draw.choice(4, p=[0.1, 0.7, 0.15, 0.05])])
        for t in range(3000)
    ]
    faults = symbols(rows)
    seen, small = set(), {}
    for bound in (CHUNK_IN_USE := dialogue.CHUNK, 64):
        monkeypatch.setattr(dialogue, "CHUNK", bound)
        monkeypatch.setattr(dialogue, "SPILL_BYTES", 8 << 20 if bound == CHUNK_IN_USE else 2000)
        seen = set()
        conversation = dialogue._Conversation("v1")
        for turn, role, text in rows:
            conversation.add(str(turn), role, text, (role, text) in seen)
            seen.add((role, text))
        small[bound] = list(conversation.edits())
        assert (conversation.rows.file is None) == (bound == CHUNK_IN_USE)
    assert small[64] == small[CHUNK_IN_USE]
    assert [fault for edit, _, _, fault, _ in small[64] if edit != "I"] == faults
    out = "".join(role[0] for edit, role, *_ in small[64] if edit != "D")
    assert LEGAL.fullmatch(out)
    # Cost by the plain recurrence over the four states.
    cost = [0, 10**9, 10**9, 10**9]  # paid so far, forwards
    due = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
    def inserts(now):
        for _ in range(4):
            for s, (to, _) in due.items():
                now[to] = min(now[to], now[s] + 2)
        return now
    cost = inserts(cost)
    for (_, role, _), fault in zip(rows, faults):
        now = [c + 3 for c in cost]
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            for s, (to, initial) in due.items():
                now[to] = min(now[to], cost[s] + late + (0 if role[0] == initial else 2))
            if role[0] == "s":
                now[1] = min(now[1], cost[0] + late)
        cost = inserts(now)
    paid = sum({"D": 3, "I": 2, "R": 2, "K": 0}[e] + (f == "truncated" and e != "D") for e, _, _, f, _ in small[64])
    assert paid == min(cost[0], cost[3])
    report = dialogue.report(table(spark, {1: rows}).repartition(4)).first()
    assert report.cost == paid and report.audit == "".join(e for e, *_ in small[64])


def test_defined_cases(spark):
    conversations = {
        1: [(None, "user", "First."), (5, "assistant", "Last."), (9, "assistant", "Last.")],
        2: [(None, "user", "A."), (None, None, None)],
        3: [(2, "user", "Same."), (2, "user", "Same."), (2, "assistant", "x.")],
        4: [(0, "", "no role."), (1, "Assistant", "capital.")],
        5: [(0, "user", "é" * 30_000 + "."), (1, "assistant", "ok.")],
        None: [(0, "user", "no id."), (1, "assistant", "fine.")],
    }
    frame = table(spark, conversations)
    clash = frame.selectExpr("*", *(f"'own' AS `{c}`" for c in ("_conv", "_turn", "_role", "_text", "_repeated", "_key", "place", "edit")))
    found = {r.conv_id: r for r in dialogue.report(clash).collect()}
    assert (found[1].gaps, found[1].duplicate, found[1].audit) == (3, 1, "KKD")
    assert (found[2].gaps, found[2].blank, found[2].audit) == (0, 1, "DKI")  # a null role sorts first
    assert (found[3].gaps, found[3].duplicate, found[3].illegal) == (0, 1, 1)  # order: assistant, user, user
    assert found[4].audit == "RR" and found[4].cost == 4 and found[4].illegal == 1
    assert found[5].audit == "KK" and found[None].audit == "KK"
    assert dialogue.report(clash.limit(0)).count() == 0 and dialogue.edits(clash.limit(0)).count() == 0
    assert dialogue.repaired(clash.limit(0)).count() == 0 and dialogue.damaged(clash.limit(0)).count() == 0


def test_vanished_conversations_stay_in_the_result(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    row = QUERIES["op11_dialogues"](spark, str(tmp_path)).first()
    assert (row.conv_id, row.gaps, row.cost, row.audit) == (gone, 0, 0, "") and row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("state", range(4))
def test_vectors_are_few(state):
    assert len(dialogue.automaton().vectors) < 256  # a backpointer is one byte
    assert set(dialogue.automaton().at_end[state]) <= {"I"}
