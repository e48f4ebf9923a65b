"""Repair of damaged conversations: Knuth's lightest-derivation agenda.

A conversation is read from left to right. An item ``[i, state]`` says that the first ``i``
rows are dealt with and what the roles so far allow next; an item and a row together derive
the next item by keeping, changing or deleting the row, and an item alone derives another by
an inserted turn. The weight of a derivation is (cost, audit): the costs of its edits added
up and their initials in order. Adding an edit makes both parts grow and keeps the order of
two derivations of one item, so the functions are superior: the agenda pops items by weight,
the first weight that an item is popped with is its least, and the goal is final when popped.

A repaired conversation has role initials ``(s?(ua)+)?``. Keeping costs nothing, changing a
role to user or assistant 3, deleting 4, inserting a turn without text 3; a truncated row
that stays costs 3 more. Blank rows and duplicates must go.

Work on Spark: equal rows are counted, first appearances are found by one aggregate over
(conversation, role, hash of the text) and a join, so nothing is looked up in a task.
Conversations then pass a task in order, as rows of a few bytes without their texts; the
agenda runs over blocks of ``BLOCK`` rows and hands on one weight per state, less the audit
that these share. No conversation is held, however long. Texts are moved once, to be edited.

Defined results: rows go by turn (NULL first), rows of one turn by role and the md5 of their
text; NULL role or text counts as one space; equal rows are duplicates of the first; a role
counts by its first character; NULL is a conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hotdesk.llm.batches import in_batches, records
from hotdesk.llm.tables import stored

BLOCK = 256

# ---- fixed values: costs of the edits, roles ---------------------------------
CHANGE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
LEGAL = ("su", "ua", "au")
# ---- end of fixed values -----------------------------------------------------

FINE, CUT, SEEN, BLANK = range(4)
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, OPENED, ASKED, ANSWERED = range(4)
ENDS = (START, ANSWERED)
KEPT = {("s", START): OPENED, ("u", START): ASKED, ("u", OPENED): ASKED, ("u", ANSWERED): ASKED, ("a", ASKED): ANSWERED}
NEXT = {START: (USER, ASKED), OPENED: (USER, ASKED), ASKED: (ASSISTANT, ANSWERED), ANSWERED: (USER, ASKED)}

Weight = tuple[int, str]


def conclusions(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """What an item and the next row derive: (edit, cost, state)."""
    yield "D", DELETE, state
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        yield "R", CHANGE + extra, NEXT[state][1]
        if (initial, state) in KEPT:
            yield "K", extra, KEPT[initial, state]


def lightest(start: dict[int, Weight], rows: list[tuple[str, int]], final: bool) -> dict[int, Weight]:
    """Least weights of the items after all rows, by state; with ``final`` that of the goal alone, as START."""
    agenda = [(cost, audit, 0, state) for state, (cost, audit) in start.items()]
    heapq.heapify(agenda)
    done, goal = set(), len(rows) + 1
    ends: dict[int, Weight] = {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == goal:
            return {START: (cost, audit)}
        if at < len(rows):
            for edit, more, after in conclusions(state, *rows[at]):
                if (at + 1, after) not in done:
                    heapq.heappush(agenda, (cost + more, audit + edit, at + 1, after))
        elif not final:
            ends[state] = cost, audit
        elif state in ENDS:
            heapq.heappush(agenda, (cost, audit, goal, START))
        if (at, NEXT[state][1]) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, NEXT[state][1]))
    return ends


class Repair:
    """One conversation, row after row."""

    def __init__(self) -> None:
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.rows: list[tuple[str, int]] = []
        self.last: str | None = None
        self.weights: dict[int, Weight] = {START: (0, "")}
        self.shared: list[str] = []
        self.turns: list[int] = []

    def add(self, turn: int | None, initial: str, fault: int, times: int) -> None:
        if times and turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        for _ in range(times):
            self.faults[fault] += 1
            if self.last is not None and self.last + initial not in LEGAL:
                self.illegal += 1
            self.last = initial
            self.rows.append((initial, fault))
            fault = max(fault, SEEN)
            if len(self.rows) == BLOCK:
                self._advance(False)

    def _advance(self, final: bool) -> None:
        self.weights = lightest(self.weights, self.rows, final)
        same = commonprefix([audit for _, audit in self.weights.values()])
        self.shared.append(same)
        self.weights = {q: (cost, audit[len(same) :]) for q, (cost, audit) in self.weights.items()}
        self.rows = []

    def result(self) -> tuple:
        self._advance(True)
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        _, truncated, duplicate, blank = self.faults
        return gaps, blank, duplicate, truncated, self.illegal, self.weights[START][0], "".join(self.shared)


def _white_ended(mark: str) -> str:
    return mark + r"[\x20\x09-\x0D]*+\z"


def _taken(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, times: str | None) -> DataFrame:
    """The columns in use, NULLs filled, under names of their own."""
    space = F.lit(" ")
    named = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        (F.col(times) if times else F.lit(1)).cast("long").alias("times"),
    )
    return named.withColumn("text_id", F.md5(F.col("text").cast("binary")))


def _diagnosed(taken: DataFrame) -> DataFrame:
    """Distinct rows without texts: how often they stand there, and their fault."""
    text = F.col("text")
    slim = taken.select(
        "conv_id",
        "turn",
        "role",
        "text_id",
        "times",
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(_white_ended("[.!?]"))).alias("cut"),
    )
    counted = slim.groupBy("conv_id", "turn", "role", "text_id").agg(
        F.sum("times").alias("times"), F.bool_or("blank").alias("blank"), F.bool_or("cut").alias("cut")
    )
    # NULL turns come first, so they are the least.
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = (
        counted.where("times > 0")
        .groupBy("conv_id", "role", "text_id")
        .agg(F.min(place).alias("first"))
        .alias("f")
    )
    counted = counted.alias("c")
    names = ("conv_id", "role", "text_id")
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"c.{name}").eqNullSafe(F.col(f"f.{name}"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.struct(F.col("c.turn").isNotNull(), F.col("c.turn")) != F.col("first"), SEEN)
        .when(F.col("cut"), CUT)
        .otherwise(FINE)
    )
    return counted.join(first, same, "left").select(
        *[F.col(f"c.{n}") for n in ("conv_id", "turn", "role", "text_id", "times")],
        F.substring("c.role", 1, 1).alias("initial"),
        F.coalesce(fault, F.lit(FINE)).alias("fault"),
    )


def plan(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    times: str | None = None,
) -> DataFrame:
    """Per conversation what is wrong with it, and its cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``times`` names a
    column that says how often a row stands there; a conversation whose rows all stand there
    zero times has zeros and an empty audit.
    """
    found = _diagnosed(_taken(rows, conv_id, turn, role, text, times))
    kind = found.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ordered = (
        found.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text_id")
        .select("conv_id", "turn", "initial", "fault", "times")
    )

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        key, current = None, None
        for conv, at, initial, fault, copies in records(batches):
            if current is None or conv != key:
                if current is not None:
                    result = current.result()
                    yield len(result[-1]), (key, *result)
                key, current = conv, Repair()
            current.add(at, initial, fault, copies)
        if current is not None:
            result = current.result()
            yield len(result[-1]), (key, *result)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, solved(batches))

    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(found.schema["conv_id"].dataType)),
            *((n, pa.int64()) for n in counts),
            ("audit", pa.string()),
        ]
    )
    return ordered.mapInArrow(
        solve, f"conv_id {kind}, {', '.join(f'{n} long' for n in counts)}, audit string"
    )


def repaired(
    rows: DataFrame,
    plans: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    times: str | None = None,
) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), edit, role, text.

    ``plans`` are those of :func:`plan` for the same rows. A conversation's turns lie in one
    partition, in order; one without turns has no rows.
    """
    taken = _taken(rows, conv_id, turn, role, text, times)
    head = plans.select(
        "conv_id",
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(0).cast("long").alias("times"),
        F.lit("").alias("text_id"),
        F.lit(True).alias("head"),
    )
    kind = taken.schema["conv_id"].dataType.simpleString()
    ordered = (
        head.unionByName(taken.where("times > 0").withColumn("head", F.lit(False)))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("head"), "turn", "role", "text_id")
        .select("conv_id", "head", "role", "text", "times")
    )

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        key, audit, at, place, state = None, "", 0, 0, START
        for conv, is_head, own, body, copies in _with_end(records(batches)):
            if is_head:
                while at < len(audit):
                    new, state = NEXT[state]
                    yield 0, (key, place, "I", new, "")
                    at, place = at + 1, place + 1
                key, audit, at, place, state = conv, body, 0, 0, START
            for _ in range(copies):
                while audit[at] == "I":
                    new, state = NEXT[state]
                    yield 0, (key, place, "I", new, "")
                    at, place = at + 1, place + 1
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                if edit == "R":
                    own, state = NEXT[state]
                else:
                    state = KEPT[own[:1], state]
                yield len(body), (key, place, edit, own, body)
                place += 1

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, edited(batches))

    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(taken.schema["conv_id"].dataType)),
            ("place", pa.int64()),
            ("edit", pa.string()),
            ("role", pa.string()),
            ("text", pa.string()),
        ]
    )
    return ordered.mapInArrow(edit, f"conv_id {kind}, place long, edit string, role string, text string")


def _with_end(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The records and an empty head behind them, so that the last conversation is closed."""
    yield from rows
    yield None, True, "", "", 0


def hashed(turns: DataFrame) -> DataFrame:
    """conv_id and the sha256 of ``role:text`` lines; ``turns`` as :func:`repaired` leaves them."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        key, state = None, None
        for conv, role, text in records(batches):
            if state is None or conv != key:
                if state is not None:
                    yield 0, (key, state.hexdigest())
                key, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if state is not None:
            yield 0, (key, state.hexdigest())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, digests(batches))

    schema = pa.schema(
        [("conv_id", to_arrow_type(turns.schema["conv_id"].dataType)), ("sha256", pa.string())]
    )
    return turns.select("conv_id", "role", "text").mapInArrow(digest, f"conv_id {kind}, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a hash of ``conv_id:turn`` (NULL: one space); ``times`` says how often a row stands."""
    space = F.lit(" ")
    parts = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """What is wrong with each damaged conversation, its cheapest repair and the hash of the repaired turns."""
    rows = damaged(conversations)
    plans = stored(plan(rows, times="times"), "repairs").alias("p")
    hashes = hashed(repaired(rows, plans, times="times")).alias("h")
    empty = hashlib.sha256().hexdigest()
    return plans.join(hashes, F.col("p.conv_id").eqNullSafe(F.col("h.conv_id")), "left").select(
        "p.*", F.coalesce("h.sha256", F.lit(empty)).alias("repaired_sha256")
    )
