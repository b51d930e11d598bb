"""Conversation structure repair: cheapest edits that give each conversation a legal order of roles.

The legal orders of role initials are ``(s?(ua)+)?``. Edits take the rows of a conversation by
turn: keep a row (0), give it the role user or assistant (1), delete it (2; blank and duplicate
rows must go), or insert an empty row of user or assistant anywhere (5). A truncated row that
stays costs 5 more. Of the cheapest lists of edits the ASCII-least of their initials is taken.

Rows are dealt by conversation once and sorted by turn, so each conversation is one stream in
one task, of whatever length. A first stream runs from the last turn to the first and carries
the cost of finishing from each of the four states (nothing yet, after s, u, a) across the
Arrow batches. It leaves with each row a compact pointer: for every state the best edit there,
three bits each. No two choices at a row start alike, so their own initials decide ties and
later ones need not be known. Spark then sorts the rows by turn, spilling pointers and texts
alike, and a second stream follows the pointers, hashing the repaired rows as they pass. Neither
stream holds more than a batch, apart from the audit string that is asked for. The repaired
rows are given by :func:`repaired`, in the same way.

Inserting twice at one place never is cheapest: after u or a the state stays what it was, from
the start it only loses choices, and after s deleting that s is cheaper.

Nulls: a null role or text stands as one space, which is no legal initial and blank; rows of a
null turn come first, those of a null conversation are one conversation. Rows of one turn are
taken by role, then text, so that repeated rows are neighbours; a row is a duplicate if an
earlier one has its role and text. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

_SPACE = " \t\n\x0b\x0c\r"
#: Faults of rows, first one first.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Edits at a row in ASCII order; the pointer of a state is the number of its edit.
EDITS = ("D", "ID", "IK", "IR", "K", "R")
INSERT, REROLE, DELETE, CUT_OFF = 5, 1, 2, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after user or assistant is said, where that is legal.
SAYS = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
NAMES = {AFTER_U: "user", AFTER_A: "assistant"}
KEPT = {("s", START): AFTER_S, ("u", START): AFTER_U, ("u", AFTER_S): AFTER_U,
        ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}
#: Cost of ending in each state, and what is inserted for it.
ENDS = {START: (0, ""), AFTER_S: (2 * INSERT, "II"), AFTER_U: (INSERT, "I"), AFTER_A: (0, "")}
#: Pairs of neighbouring initials that are legal.
LEGAL = {"su", "ua", "au"}


def damage(conversations: DataFrame) -> DataFrame:
    """Damaged rows: conv_id, turn, role, text and ``dropped``; dropped rows stay, marked."""
    text, one = F.coalesce("text", F.lit(" ")), F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), one))
    kind = F.crc32(key) % 20
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", one)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")) \
        .drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, with ``fault`` and ``again``, the number of equal rows before."""
    same = Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.asc_nulls_first("turn"))
    rows = rows.repartition("conv_id").withColumn("again", F.row_number().over(same) - 1)
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    fault = F.when(last == "", BLANK).when(F.col("again") > 0, DUPLICATE) \
        .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    return rows.withColumn("fault", fault.cast("int"))


_ORDER = ("conv_id", "turn", "role", "text", "again")
_TYPES = "turn long, role string, text string, dropped boolean, again int, fault int, " \
         "pointers int, cost long"


def _key(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, "


def choices(initial: str, fault: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs of finishing from each state before a row, and its pointers, from those after it."""
    must_go, more = fault in (BLANK, DUPLICATE), CUT_OFF if fault == TRUNCATED else 0
    out, pointers = [], 0
    for state in range(4):
        best = None
        for number, edit in enumerate(EDITS):
            at, cost = (SAYS[state], INSERT) if edit[0] == "I" else (state, 0)
            if edit[-1] == "D":
                cost += DELETE
            elif must_go or (edit[-1] == "K" and (initial, at) not in KEPT):
                continue
            else:
                keep = edit[-1] == "K"
                at, cost = KEPT[initial, at] if keep else SAYS[at], cost + more + (0 if keep else REROLE)
            if best is None or cost + costs[at] < best[0]:
                best = cost + costs[at], number
        out.append(best[0])
        pointers |= best[1] << 3 * state
    return tuple(out), pointers


def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last to the first, each with its pointers and its cost of finishing from nothing."""
    ends = tuple(ENDS[state][0] for state in range(4))
    # Costs are kept as their least and what lies above it, of which there are few kinds.
    known: dict[tuple, tuple] = {}
    now, least, above = object(), 0, ends
    for batch in batches:
        columns = [batch.column(c) for c in range(batch.num_columns)]
        names = batch.schema.names
        pointers, costs = [], []
        conv, role, fault, dropped = (columns[names.index(c)].to_pylist()
                                      for c in ("conv_id", "role", "fault", "dropped"))
        for k in range(batch.num_rows):
            if conv[k] != now:
                now, least, above = conv[k], 0, ends
            code = 0
            if not dropped[k]:
                initial = role[k][:1] if role[k][:1] in ("s", "u", "a") else ""
                step = known.get((initial, fault[k], above))
                if step is None:
                    after, code = choices(initial, fault[k], above)
                    low = min(after)
                    step = known[initial, fault[k], above] = code, low, tuple(c - low for c in after)
                code, low, above = step
                least += low
            pointers.append(code)
            costs.append(least + above[START])
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(pointers, pa.int32()), pa.array(costs, pa.int64())],
            [*names, "pointers", "cost"])


def pointed(rows: DataFrame) -> DataFrame:
    """Rows of :func:`damage` (or others of its columns) in order, with faults and pointers."""
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       F.coalesce("dropped", F.lit(False)).alias("dropped"))
    back = _faults(rows).sortWithinPartitions(*[F.col(c).desc_nulls_last() for c in _ORDER])
    return back.mapInArrow(_pointed, _key(rows) + _TYPES) \
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in _ORDER])


class _Walk:
    """Follows the pointers of one conversation and sums up what it sees."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost = conv_id, START, None
        self.audit, self.sha, self.lines = bytearray(), hashlib.sha256(), 0
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.low = self.high = self.turn = None
        self.turns = 0

    def say(self, role: str, text: str) -> tuple[str, str]:
        if self.lines:
            self.sha.update(b"\n")
        self.lines += 1
        self.sha.update(f"{role}:".encode())
        self.sha.update(text.encode())
        return role, text

    def insert(self) -> tuple[str, str]:
        self.state = SAYS[self.state]
        return self.say(NAMES[self.state], "")

    def row(self, turn, role: str, text: str, fault: int, pointers: int, cost: int):
        """Takes a row; gives the repaired rows that stand for it."""
        if self.cost is None:
            self.cost = cost
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        edit = EDITS[pointers >> 3 * self.state & 7]
        self.audit += edit.encode()
        if edit[0] == "I":
            yield self.insert()
        if edit[-1] == "K":
            self.state = KEPT[initial, self.state]
            yield self.say(role, text)
        elif edit[-1] == "R":
            self.state = SAYS[self.state]
            yield self.say(NAMES[self.state], text)

    def end(self):
        for letter in ENDS[self.state][1]:
            self.audit += letter.encode()
            yield self.insert()

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED],
                self.illegal, self.cost or 0, self.audit.decode(), self.sha.hexdigest())


def _walked(batches: Iterator[pa.RecordBatch], said, ended):
    """Walks all conversations of a partition; ``said`` and ``ended`` take what comes out."""
    walk = None
    names = ("conv_id", "turn", "role", "text", "dropped", "fault", "pointers", "cost")
    for batch in batches:
        for conv, turn, role, text, dropped, fault, pointers, cost in zip(
                *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
            if walk is None or conv != walk.conv_id:
                if walk:
                    said(walk, walk.end())
                    ended(walk)
                walk = _Walk(conv)
            if not dropped:
                said(walk, walk.row(turn, role, text, fault, pointers, cost))
        yield
    if walk:
        said(walk, walk.end())
        ended(walk)
        yield


_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, " \
         "audit string, repaired_sha256 string"


def _batch(rows: list[tuple], types: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names, of = zip(*(field.split() for field in types.split(", ")))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds.get(kind)) for column, kind in zip(zip(*rows), of)], names)


def audit(rows: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cost and initials of its edits, a hash of the result.

    ``gaps`` counts missing turns, ``illegal`` neighbouring initials that are not su, ua or au.
    """
    types = _key(rows) + _AUDIT

    def summed(batches):
        out = []
        def said(walk, lines):
            for _ in lines:
                pass
        for _ in _walked(batches, said, lambda walk: out.append(walk.summary())):
            if out:
                yield _batch(out, types)
                out.clear()

    return pointed(rows).mapInArrow(summed, types)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, ``place`` (from 0), role and text."""
    types = _key(rows) + "place long, role string, text string"

    def lines(batches):
        out = []
        def said(walk, found):
            place = walk.lines
            for role, text in found:
                out.append((walk.conv_id, place, role, text))
                place += 1
        for _ in _walked(batches, said, lambda walk: None):
            if out:
                yield _batch(out, types)
                out.clear()

    return pointed(rows).mapInArrow(lines, types)
