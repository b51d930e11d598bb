"""Conversation repair against a search over all lists of edits."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from pathlib import Path

import pytest

from roadpulse.llm import conversations
from roadpulse.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, dropped boolean"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def order(row):
    return row[1] is not None, row[1] or 0, row[2].encode(), row[3].encode()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_audit(conv, rows):
    """All edits of one conversation, by search; ties by the whole string."""
    rows = sorted(rows, key=order)
    faults, seen = [], set()
    for _, _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen
                      else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for name in ("user", "assistant"):
                if (state, name[0]) in NEXT:
                    c, s, r = best(i, name[0], inserted + 1)
                    found.append((c + 5, "I" + s, ((name, ""),) + r))
        if i < len(rows):
            role, text = rows[i][2:4]
            c, s, r = best(i + 1, state, 0)
            found.append((c + 2, "D" + s, r))
            if faults[i] not in ("blank", "duplicate"):
                for letter, name in (("K", role), ("R", "user"), ("R", "assistant")):
                    if (state, name[:1]) in NEXT:
                        c, s, r = best(i + 1, NEXT[state, name[:1]], 0)
                        found.append((c + (letter == "R") + 5 * (faults[i] == "truncated"), letter + s,
                                      ((name, text),) + r))
        return min(found) if found else (10 ** 9, "", ())

    cost, audit, lines = best(0, "", 0)
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (
        "blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(
            initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()), lines


def plain(rows, every):
    by = {conv: [] for conv in every}
    for row in rows:
        by[row[0]].append(row)
    return Counter(plain_audit(conv, own)[0] for conv, own in by.items())


def some_rows(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "umpire", "System", "user", "assistant"]
    texts = ["Yes.", "No!", "why", "", " \n\t", "so.  ", "«Ünï»?", "a.b", " ", "x" * 50, "…", "Ok.\x0b"]
    return [(rng.randrange(-2, n // 6), rng.choice([None, *range(-1, 9)]), rng.choice(roles),
             rng.choice(texts)) for _ in range(n)]


def test_random_conversations(spark):
    rows = some_rows(1500, 4)
    frame = spark.createDataFrame([(*r, False) for r in rows], SCHEMA).repartition(5)
    assert Counter(map(tuple, conversations.audit(frame).collect())) == plain(rows, {r[0] for r in rows})


def test_repaired_rows(spark):
    rows = some_rows(300, 9)
    frame = spark.createDataFrame([(*r, False) for r in rows], SCHEMA).repartition(3)
    got = {}
    for r in conversations.repaired(frame).orderBy("conv_id", "place").collect():
        assert r.place == len(got.setdefault(r.conv_id, []))
        got[r.conv_id].append((r.role, r.text))
    for conv in {r[0] for r in rows}:
        lines = got.get(conv, [])
        assert lines == list(plain_audit(conv, [r for r in rows if r[0] == conv])[1])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in lines))


def test_damage_and_nulls(spark):
    rows = [(c, t, r, x) for c in (None, *range(60)) for t, r, x in
            [(None, "system", "S."), (0, "user", "Hi?"), (1, "assistant", None), (1, None, "tie."),
             (2, "user", "Who."), (5, "assistant", "Me!"), (None, None, None)]]
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows],
                                  "conv_id long, turn long, role string, text string, copy int, again string")
    got = conversations.audit(conversations.damage(frame.repartition(4)))
    assert Counter(map(tuple, got.collect())) == plain(plain_damage(rows), {r[0] for r in rows})


def test_all_rows_gone(spark):
    frame = spark.createDataFrame([(7, 1, "user", "x", True), (7, 2, "user", "y", True)], SCHEMA)
    assert [tuple(r) for r in conversations.audit(frame).collect()] == [
        (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.repaired(frame).collect() == []
    assert conversations.audit(frame.limit(0)).collect() == []


def test_giant_conversation_and_long_text(spark):
    """One conversation over many Arrow batches, among small ones, and a text of megabytes."""
    rng = random.Random(3)
    giant = [(1, k, rng.choice(["user", "assistant", "tool"]), f"{k}{rng.choice(['.', '', '?'])}")
             for k in range(30_000)]
    rows = giant + [(0, 0, "user", "a."), (2, 0, "assistant", "b."), (3, 1, "user", "long " * 400_000 + "!"),
                    (3, 2, "assistant", "c.")]
    frame = spark.createDataFrame([(*r, False) for r in rows], SCHEMA).repartition(4)
    got = {r.conv_id: r for r in conversations.audit(frame).collect()}
    assert {c: (got[c].cost, got[c].audit) for c in (0, 2, 3)} == {0: (2, "D"), 2: (2, "D"), 3: (0, "KK")}
    # Costs by a plain table over the four states; the audit has to cost as much.
    inf = 10 ** 9
    states = {"": 0, "s": inf, "u": inf, "a": inf}
    for _, _, role, text in giant:
        cut = 5 * (text[-1] not in ".!?")
        for _ in range(2):
            for (state, to) in NEXT:
                if to != "s":
                    states[to] = min(states[to], states[state] + 5)
        new = {s: c + 2 for s, c in states.items()}
        for (state, to) in NEXT:
            keep = 0 if role[0] == to else 1 if to in "ua" else inf
            new[to] = min(new[to], states[state] + cut + keep)
        states = new
    cost = min(states[""], states["a"], states["u"] + 5)
    audit = got[1].audit
    assert got[1].cost == cost
    cuts = [5 * (text[-1] not in ".!?") for *_, text in giant]
    done = [c for c in audit if c != "I"]
    assert len(done) == len(giant) and cost == 5 * audit.count("I") + sum(
        2 if c == "D" else cut + (c == "R") for c, cut in zip(done, cuts))


def test_one_shuffle(spark):
    """Damage, both streams and the window need no second exchange."""
    frame = spark.createDataFrame([(1, 1, "user", "x", False)], SCHEMA)
    plan = conversations.audit(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations")
            .select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversations"](spark, SF_DIR)
    assert Counter(map(tuple, got.collect())) == plain(plain_damage(rows), {r[0] for r in rows})
