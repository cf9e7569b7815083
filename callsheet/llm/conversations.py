"""Repair of conversations by the cheapest edits.

The rows of a conversation should read as roles ``(system? (user assistant)+)?``.
Rows are kept, given another role, deleted or inserted, each at a cost, and a
dynamic program over the (few) states of that pattern finds the cheapest way.

Rows are sent to one task by conversation and sorted by turn, last row first.
A stream over the Arrow batches carries the program's state, the least cost of
what follows from each state, from batch to batch; what it decides for each
state at a row fits one byte, the back pointer, which stays with the row.
Sorted again, first row first (in the same task, no further exchange), a
second stream follows the pointers from the start.  Spark's sort spills rows
and pointers where a conversation is giant; a task holds one batch, four costs
and the digest of the row it is at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits; a truncated row that is not deleted adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Edits in ASCII order, which settles ties; their places are the two-bit codes in a pointer.
EDITS = "DIKR"
_D, _I, _K, _R = range(4)
# states: what stands last so far
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The role that must come next (user or assistant) and the state it leads to.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FAULTS = ("", "blank", "duplicate", "truncated")
_ORDER = ("turn", "role", "text", "copy")


def fault(text: Column, copy: Column) -> Column:
    """The first fault of a row: 1 blank (nothing but white space), 2 a copy of
    an earlier one, 3 truncated (the last other character is none of ``.!?``); 0 none."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), 1).when(copy > 1, 2)
            .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0).cast("int"))


def end_costs() -> list[int]:
    """Cost of what must still be inserted after the last row, by state."""
    return [0, 2 * INSERT, INSERT, 0]


def decide(after: list[int], initial: str, wrong: int) -> tuple[list[int], int]:
    """Costs before a row from the costs after it, and its pointer: for each
    state the edit to do next there (two bits), an insertion leading to
    another state of the same row.  Of equally cheap edits the one with the
    least letter is taken, which makes the least string of letters."""
    extra = TRUNCATED if wrong == 3 else 0
    keeps = INITIALS.get(initial)
    direct = []
    for state in range(STATES):
        options = [(DELETE + after[state], _D)]
        if wrong not in (1, 2):
            if keeps == NEXT[state] or keeps == SYSTEM and state == START:
                options.append((extra + after[keeps], _K))
            options.append((REROLE + extra + after[NEXT[state]], _R))
        direct.append(min(options))
    before = [cost for cost, _ in direct]
    for _ in range(3):  # insertions lead round user, assistant, user
        before = [min(before[s], INSERT + before[NEXT[s]]) for s in range(STATES)]
    pointer = 0
    for state in range(STATES):
        options = [(direct[state][0], direct[state][1])] + [(INSERT + before[NEXT[state]], _I)]
        pointer |= min(options)[1] << 2 * state
    return before, pointer


def _pointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their pointer; they come by conversation, last row first."""
    last, first, after = None, True, end_costs()
    memo: dict[tuple, tuple[list[int], int]] = {}
    for batch in batches:
        pointers = np.zeros(batch.num_rows, np.int32)
        key, role, wrong, absent = (batch.column(c).to_pylist() for c in ("key", "role", "fault", "absent"))
        for i in range(batch.num_rows):
            if first or last != key[i]:
                last, first, after = key[i], False, end_costs()
            if absent[i]:
                continue
            base = min(after)  # costs differ by a few units, so few cases occur
            case = (*[x - base for x in after], role[i][:1], wrong[i])
            if case not in memo:
                memo[case] = decide(list(case[:STATES]), role[i][:1], wrong[i])
            rel, pointers[i] = memo[case]
            after = [x + base for x in rel]
            if len(memo) > 100_000:
                memo.clear()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pointers)], names=[*batch.schema.names, "pointer"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation in order; rows come first row first.  An
    absent row gives one row without an edit, which keeps its conversation known."""
    names = ["key", "turn", "role", "text", "fault", "edit", "new_role", "cost"]
    types = [pa.null(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32()]
    last, first, state = None, True, START

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    def closing() -> list[tuple]:
        need = {USER: [ASSISTANT], SYSTEM: [USER, ASSISTANT]}.get(state, [])
        return [(last, None, None, "", 0, "I", NAMES[r], INSERT) for r in need]

    for batch in batches:
        out: list[tuple] = []
        types[0] = batch.column("key").type
        columns = (batch.column(c).to_pylist() for c in ("key", "turn", "role", "text", "fault", "absent", "pointer"))
        for key, turn, role, text, wrong, absent, pointer in zip(*columns, strict=True):
            if first or last != key:
                if not first:
                    out += closing()
                last, first, state = key, False, START
            if absent:
                out.append((key, None, None, None, 0, "", None, 0))
                continue
            while (edit := pointer >> 2 * state & 3) == _I:
                state = NEXT[state]
                out.append((key, None, None, "", 0, "I", NAMES[state], INSERT))
            extra = TRUNCATED if wrong == 3 else 0
            if edit == _D:
                out.append((key, turn, role, text, wrong, "D", None, DELETE))
            elif edit == _K:
                state = INITIALS[role[0]]
                out.append((key, turn, role, text, wrong, "K", role, extra))
            else:
                state = NEXT[state]
                out.append((key, turn, role, text, wrong, "R", NAMES[state], REROLE + extra))
        if out:
            yield rows(out)
    if not first and (rest := closing()):
        yield rows(rest)


def repair_edits(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                 text_column: str = "text", absent_column: str | None = None) -> DataFrame:
    """(key, turn, role, text, fault, edit, new_role, cost): the cheapest edits of every conversation.

    Rows of a conversation (``key`` is its id) stand together in one
    partition, in the order of the repaired conversation with deleted rows
    (``edit`` D, ``new_role`` null) in their old places; inserted ones (I) have
    a null turn and role and an empty text.  The repaired conversation is
    ``new_role`` and ``text`` of the rows with a ``new_role``.  Faults are
    numbered as in ``FAULTS``.

    Rows are taken by turn, null turns first, rows of one turn by role, text
    and copy.  A null role or text is one space, a null id is an id.  A role
    that is empty or begins with none of s, u, a cannot be kept.  Repeated rows
    are copies of each other.  Rows whose ``absent_column`` is true only make
    their conversation known (an edit ''); other columns are ignored, whatever
    their names; an empty table gives none.
    """
    absent = F.coalesce(F.col(absent_column), F.lit(False)) if absent_column else F.lit(False)
    kind = rows.schema[id_column].dataType.simpleString()
    plain = rows.select(F.col(id_column).alias("key"), F.col(turn_column).cast("long").alias("turn"),
                        F.coalesce(F.col(role_column), F.lit(" ")).alias("role"), F.coalesce(F.col(text_column), F.lit(" ")).alias("text"), absent.alias("absent"))
    # one exchange: copies, pointers and edits are all found where the conversation lies
    placed = plain.repartition("key")
    order = [F.asc_nulls_first("turn")]
    copies = Window.partitionBy("key", "role", "text", "absent").orderBy(*order)
    marked = placed.withColumn("copy", F.row_number().over(copies)).withColumn("fault", fault(F.col("text"), F.col("copy")))
    names = ["key", "turn", "role", "text", "absent", "copy", "fault"]
    down = marked.select(*names).sortWithinPartitions(F.asc_nulls_first("key"), F.desc_nulls_last("turn"), *[F.desc(c) for c in _ORDER[1:]])
    pointed = down.mapInArrow(_pointers, f"key {kind}, turn long, role string, text string, absent boolean, copy int, fault int, pointer int")
    up = pointed.sortWithinPartitions(F.asc_nulls_first("key"), F.asc_nulls_first("turn"), *[F.asc(c) for c in _ORDER[1:]])
    return up.mapInArrow(_edits, f"key {kind}, turn long, role string, text string, fault int, edit string, new_role string, cost int")


def repaired_turns(edits: DataFrame) -> DataFrame:
    """(key, turn, role, text) of the repaired conversations, in the order of ``edits``."""
    return edits.filter("new_role is not null").select("key", "turn", F.col("new_role").alias("role"), "text")


class _Report:
    """Counts of one conversation, row by row."""

    def __init__(self) -> None:
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.illegal = self.cost = 0
        self.faults = [0, 0, 0, 0]
        self.audit = bytearray()
        self.digest = hashlib.sha256()
        self.any = False

    def add(self, turn: int | None, role: str | None, text: str, wrong: int, edit: str, new_role: str | None, cost: int) -> None:
        self.audit += edit.encode()
        self.cost += cost
        if edit != "I" and edit:
            self.faults[wrong] += 1
            if turn is not None:
                if turn != self.turn:
                    self.turns += 1
                self.turn = self.high = turn
                self.low = turn if self.low is None else self.low
            initial = role[:1]
            if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = initial
        if new_role is not None:
            self.digest.update(b"\n" * self.any + f"{new_role}:{text}".encode())
            self.any = True

    def row(self, key: object) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return key, gaps, *self.faults[1:], self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest()


def repair_report(edits: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), one row per conversation of ``repair_edits`` (directly:
    its rows must still stand in their order).  ``gaps`` are turns that lack
    between the first and the last one, ``illegal`` neighbours whose roles do
    not begin with su, ua or au (both before the repair); ``audit`` has the
    edits' letters, the digest is that of ``role:text`` lines after the repair.
    """
    kind = edits.schema["key"].dataType.simpleString()
    fields = [(id_column, kind)] + [(n, "bigint") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", "string"), ("repaired_sha256", "string")]

    def rows(out: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        types = [key] + [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, last, key_type = None, None, pa.int64()
        for batch in batches:
            out, key_type = [], batch.column(0).type
            for key, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if report is None or key != last:
                    if report is not None:
                        out.append(report.row(last))
                    report, last = _Report(), key
                report.add(*row)
            if out:
                yield rows(out, key_type)
        if report is not None:
            yield rows([report.row(last)], key_type)

    return edits.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))
