"""Conversation structure repair: the cheapest edits that let user and assistant alternate.

A conversation is well formed when the first letters of its roles read ``(s?(ua)+)?``.
Its rows, taken by turn (nulls first; ties by role, then text, bytewise), may be kept (0),
given the role user or assistant (3) or deleted (4); an empty user or assistant row may be
put in anywhere (3). A blank row and a copy of an earlier row must go; a truncated row
that stays costs 3 more. The audit is the edits' first letters in order, D, I, K or R;
among the cheapest audits the least in ASCII order counts.

The lattice has a node for each (rows consumed, place in the pattern). Two searches by
Dijkstra's rule, one from the start and one from the accepting ends, run towards each
other until no cheaper or equally cheap crossing can be left. Nodes of the forward half
that lead to a crossing are marked backwards, and one walk from the start takes the
least letter that stays on a cheapest path. An audit leaves no choice of roles, so no
two edges of a node have the same letter, and no audit is the beginning of another one
of the same cost to the same node: the walk finds the least concatenation of a forward
and a reverse half without building any other.

Texts stream. A first pass sorts each conversation in the JVM and sees marks only: a byte
for each row, and 16 bytes to know copies again. Its audits are put in front of the rows
of a second pass, which applies them row by row. So a conversation of any length holds
its audit and the lattice in memory, but never its texts; as its audit is one cell, that
is bounded by what the result holds anyway.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What edits cost.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

#: White space, and marks that end a sentence.
SPACE, ENDS = " \t\n\x0b\f\r", ".!?"

#: Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: What may be written next other than a system row, and where that leads.
NEEDS = ("user", "user", "assistant", "user")
LEADS = (USER, USER, ASSISTANT, USER)
#: From which places a place is reached by what it needs.
REACHED_FROM = ((), (), (START, SYSTEM, ASSISTANT), (USER,))

#: Marks of a row: first letter of its role (s, u, a, or another), plus what is wrong with it.
LETTERS = "sua"
BAD, CUT, GONE = 4, 8, 16

#: Audits of conversations up to this many rows are remembered by each worker.
SHORT, REMEMBERED = 64, 1 << 14

SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _kept(place: int, mark: int) -> int | None:
    """Where keeping a row leads, if it can be kept there."""
    letter = mark & 3
    if letter == 0:
        return SYSTEM if place == START else None
    if letter == 1:
        return USER if place != USER else None
    return ASSISTANT if letter == 2 and place == USER else None


def _onward(node: int, rows: bytes) -> list[tuple[str, int, int]]:
    """(letter, cost, node) of each edit, in ASCII order of the letters."""
    at, place = node >> 2, node & 3
    out = [("I", INSERT, at << 2 | LEADS[place])]
    if at < len(rows):
        mark, following = rows[at], (at + 1) << 2
        out.insert(0, ("D", DELETE, following | place))
        if not mark & BAD:
            more = TRUNCATED if mark & CUT else 0
            kept = _kept(place, mark)
            if kept is not None:
                out.append(("K", more, following | kept))
            if kept != LEADS[place]:
                out.append(("R", REROLE + more, following | LEADS[place]))
    return out


def _back(node: int, rows: bytes) -> list[tuple[int, int]]:
    """(cost, node) of each edit that leads here."""
    at, place = node >> 2, node & 3
    out = [(INSERT, at << 2 | before) for before in REACHED_FROM[place]]
    if at:
        mark, earlier = rows[at - 1], (at - 1) << 2
        out.append((DELETE, earlier | place))
        if not mark & BAD:
            more = TRUNCATED if mark & CUT else 0
            if place == SYSTEM and mark & 3 == 0:
                out.append((more, earlier | START))
            for before in REACHED_FROM[place]:
                out.append((more + (0 if _kept(before, mark) == place else REROLE), earlier | before))
    return out


def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and least audit of a conversation, given its rows' marks."""
    start, ends = 0, [len(rows) << 2 | place for place in ACCEPTING]
    ahead, behind = {start: 0}, dict.fromkeys(ends, 0)
    done: set[int] = set()
    settled: set[int] = set()
    front, rear = [(0, start)], [(0, end) for end in ends]
    best = 0 if start in behind else DELETE * len(rows)  # deleting everything is always a way
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, node = heapq.heappop(front)
            if node in done:
                continue
            done.add(node)
            for _, price, to in _onward(node, rows):
                if cost + price < ahead.get(to, cost + price + 1):
                    ahead[to] = cost + price
                    heapq.heappush(front, (cost + price, to))
                    best = min(best, cost + price + behind.get(to, best))
        else:
            cost, node = heapq.heappop(rear)
            if node in settled:
                continue
            settled.add(node)
            for price, to in _back(node, rows):
                if cost + price < behind.get(to, cost + price + 1):
                    behind[to] = cost + price
                    heapq.heappush(rear, (cost + price, to))
                    best = min(best, cost + price + ahead.get(to, best))

    # Crossings of cost ``best``, then all forward nodes that lead to one.
    crosses = lambda node: ahead[node] + behind.get(node, best + 1) == best or any(
        ahead[node] + price + behind.get(to, best + 1) == best for _, price, to in _onward(node, rows)
    )
    todo = [node for node in done if crosses(node)]
    marked = set(todo)
    while todo:
        node = todo.pop()
        for price, before in _back(node, rows):
            if before in done and before not in marked and ahead[before] + price == ahead[node]:
                marked.add(before)
                todo.append(before)

    node, spent, audit = start, 0, []
    while not (spent == best and node in ends):
        for letter, price, to in _onward(node, rows):
            if spent + price + behind.get(to, best + 1) == best or (to in marked and spent + price == ahead[to]):
                node, spent = to, spent + price
                audit.append(letter)
                break
        else:
            raise AssertionError("no cheapest path goes on")
    return best, "".join(audit)


_remembered = functools.lru_cache(maxsize=REMEMBERED)(cheapest)


def _rows(turns: DataFrame, gone: str | None) -> DataFrame:
    """Only what is needed, under names of its own; null roles and texts are one space."""
    filled = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    return turns.select(
        turns["conv_id"].cast("bigint").alias("conv_id"),
        turns["turn"].cast("bigint").alias("turn"),
        filled("role").alias("role"),
        filled("text").alias("text"),
        (F.lit(False) if gone is None else F.coalesce(turns[gone], F.lit(False))).alias("gone"),
    )


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one place and in order; the sort spills, nothing is collected."""
    keys = ["conv_id", *first, "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(k) for k in keys])


def _mark() -> Column:
    trimmed = F.rtrim("text", F.lit(SPACE))
    last, letter = F.substring(trimmed, -1, 1), F.substring("role", 1, 1)
    kind = F.lit(3)
    for i, known in enumerate(LETTERS):
        kind = F.when(letter == known, i).otherwise(kind)
    wrong = F.when(trimmed == "", BAD).when(~last.isin(*ENDS), CUT).otherwise(0)
    return F.when(F.col("gone"), GONE).otherwise(kind + wrong).cast("int")


class _Seen:
    """One conversation as its marks come by."""

    def __init__(self, conv):
        self.conv, self.marks, self.keys = conv, bytearray(), set()
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, key: bytes, mark: int) -> None:
        if mark == GONE:
            return
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        letter = mark & 3
        if self.before is not None and (self.before, letter) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.before = letter
        if mark & BAD:
            self.blank += 1
        elif key in self.keys:
            self.duplicate += 1
            mark = letter | BAD
        elif mark & CUT:
            self.truncated += 1
        self.keys.add(key)
        self.marks.append(mark)

    def row(self) -> tuple:
        marks = bytes(self.marks)
        cost, audit = (_remembered if len(marks) <= SHORT else cheapest)(marks)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some thousand rows or some megabytes, whichever comes first."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if len(held) >= 4096 or size >= 8 << 20:
            yield _arrow(held, schema)
            held, size = [], 0
    if held:
        yield _arrow(held, schema)


def _fields(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def audits(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Rows without a
    conv_id are one conversation; null roles and texts are one space; null turns come first
    and count for no gap; repeated rows stay and are duplicates. ``gone`` may name a boolean column: such rows
    only name their conversation. An empty table gives no rows.
    """
    ddl = f"conv_id bigint, {SUMMARY}"
    fields = _fields(ddl)
    # The role's length in front keeps (role, text) apart from another way to cut the two.
    key = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32))
    marks = _sorted(_rows(turns, gone)).select("conv_id", "turn", key.alias("key"), _mark().alias("mark"))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen = None
        for batch in batches:
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "key", "mark")), strict=True):
                if seen is None or conv != seen.conv:
                    if seen is not None:
                        yield seen.row()
                    seen = _Seen(conv)
                seen.add(*row)
        if seen is not None:
            yield seen.row()

    return marks.mapInArrow(lambda batches: _batched(summaries(batches), fields, lambda r: len(r[-1])), ddl)


class _Repair:
    """Applies an audit to the rows of its conversation as they come by."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at = conv, audit, 0
        self.place, self.written = START, 0

    def _write(self, place: int, letter: str, turn, role: str, text: str) -> tuple:
        self.place, self.written = place, self.written + 1
        return self.conv, self.written, letter, turn, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._write(LEADS[self.place], "I", None, NEEDS[self.place], "")

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            yield self._write(1 + LETTERS.index(role[0]), "K", turn, role, text)
        elif letter == "R":
            yield self._write(LEADS[self.place], "R", turn, NEEDS[self.place], text)


_EMPTY = (None,) * len(COUNTS)


def repair(turns: DataFrame, gone: str | None = None) -> DataFrame:
    """The repaired conversations, in order, and one row for each with its audit.

    Columns: conv_id, position, edit, turn, role, text, then those of ``audits``. A row with
    position 0 stands before each conversation and has the audit's columns; rows with
    position 1 and up are the repaired rows (edit K, R or I; inserted ones have no turn) and
    have nulls there. Rows of a conversation follow one another in one partition, in order.
    See ``audits`` for nulls, copies and empty tables.
    """
    rows = _rows(turns, gone)
    heads = audits(turns, gone).select("conv_id", F.lit(0).alias("kind"), *COUNTS)
    lines = rows.filter(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    both = _sorted(heads.unionByName(lines, allowMissingColumns=True), "kind")
    ddl = f"conv_id bigint, position bigint, edit string, turn bigint, role string, text string, {SUMMARY}"
    fields = _fields(ddl)
    names = ["conv_id", "kind", "turn", "role", "text", *COUNTS]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for batch in batches:
            for conv, kind, turn, role, text, *head in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if kind == 0:
                    if now is not None:
                        yield from (r + _EMPTY for r in now.inserted())
                    now = _Repair(conv, head[-1])
                    yield (conv, 0, None, None, None, None, *head)
                else:
                    yield from (r + _EMPTY for r in now.row(turn, role, text))
        if now is not None:
            yield from (r + _EMPTY for r in now.inserted())

    weigh = lambda r: len(r[5] or "") + len(r[-1] or "")
    return both.select(*names).mapInArrow(lambda batches: _batched(apply(batches), fields, weigh), ddl)


def damage(turns: DataFrame) -> DataFrame:
    """Faults by the checksum of ``conv_id:turn`` (nulls: one space): conv_id, turn, role, text, dropped.

    Of twenty remainders, 0 drops the row (it stays, marked, to name its conversation), 1
    empties its text, 2 removes what ends sentences, 3 repeats the row, 4 makes it the user's.
    """
    filled = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    told = turns.select(
        turns["conv_id"].cast("bigint").alias("conv_id"),
        turns["turn"].cast("bigint").alias("turn"),
        filled("role").alias("role"),
        filled("text").alias("text"),
        fault.alias("fault"),
    )
    fault = F.col("fault")
    times = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return told.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(times).alias("time"),
    ).drop("time")


def digest(turns: DataFrame) -> DataFrame:
    """The registered query's columns: ``turns`` damaged, then repaired."""
    ddl = f"conv_id bigint, {SUMMARY}, repaired_sha256 string"
    fields = _fields(ddl)
    names = ["conv_id", "position", "role", "text", *COUNTS]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, hasher = None, None
        for batch in batches:
            for conv, position, role, text, *counts in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if position == 0:
                    if head is not None:
                        yield (*head, hasher.hexdigest())
                    head, hasher = (conv, *counts), hashlib.sha256()
                else:
                    hasher.update(f"{'' if position == 1 else chr(10)}{role}:{text}".encode())
        if head is not None:
            yield (*head, hasher.hexdigest())

    repaired = repair(damage(turns), gone="dropped").select(*names)
    return repaired.mapInArrow(lambda batches: _batched(hashed(batches), fields, lambda r: len(r[-2])), ddl)
