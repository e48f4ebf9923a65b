"""Conversation repair against an exhaustive search and a plain damage."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from hotdesk.llm import conversation_repair as repair
from hotdesk.llm.tables import read

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\v\f\r"


def cheapest(rows: list[tuple[str, str]]) -> tuple:
    """Faults, illegal pairs, cost, audit and repaired turns of one conversation, by all shortest edits."""
    seen, faults = set(), []
    for role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        fault = "blank" if not last else "dup" if (role, text) in seen else "cut" if last not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    final = None
    frontier = [(0, "", 0, ())]
    limit = 4 * len(rows)  # deleting everything
    while frontier:
        cost, audit, at, turns = frontier.pop()
        shape = "".join(r[:1] or "?" for r, _ in turns)
        if cost > limit or not re.fullmatch("(s|s?(ua)+u?|su)?|u|s?(ua)*u", shape):
            continue
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            if final is None or (cost, audit) < final[:2]:
                final = cost, audit, turns
                limit = min(limit, cost)
        if cost + 3 <= limit:
            for role in ("user", "assistant"):
                frontier.append((cost + 3, audit + "I", at, (*turns, (role, ""))))
        if at < len(rows):
            role, text = rows[at]
            frontier.append((cost + 4, audit + "D", at + 1, turns))
            if faults[at] in ("", "cut"):
                extra = 3 if faults[at] else 0
                frontier.append((cost + extra, audit + "K", at + 1, (*turns, rows[at])))
                for new in ("user", "assistant"):
                    frontier.append((cost + 3 + extra, audit + "R", at + 1, (*turns, (new, text))))
    return tuple(faults.count(f) for f in ("blank", "dup", "cut")), illegal, *final


def expected(table: list[tuple]) -> dict:
    kept = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept[conv] += [(turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text)] * (
            0 if fate == 0 else 2 if fate == 3 else 1
        )
    out = {}
    for conv, rows in kept.items():
        rows.sort()
        turns = [r[1] for r in rows if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, illegal, cost, audit, turns = cheapest([(r[2], r[4]) for r in rows])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, sha)
    return out


def made(seed: int, conversations: int = 150) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 4)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "and", " \t", "", None, "é. \n", "why?"])
            rows.append((conv * 7919, rng.choice([turn, turn, turn * 2, None]), role, text))
    return rows


@pytest.mark.parametrize("block", [256, 2])
def test_repairs_are_the_cheapest(spark, monkeypatch, block):
    rows = made(block)
    solved = {}
    if block == 256:
        table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS audit", "1 AS times", "2 AS head")
        solved = {r[0]: tuple(r)[1:] for r in repair.digest(table).collect()}
        assert solved == expected(rows)
        return
    # In blocks of two rows, without Spark.
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(5)
    for _ in range(300):
        one = [(rng.choice("suat") + "x", rng.choice(["a.", "b.", "c", ""])) for _ in range(rng.randint(0, 6))]
        faults, illegal, cost, audit, _ = cheapest(one)
        state, seen = repair.Repair(), set()
        for turn, row in enumerate(one):
            fault = repair.BLANK if not row[1] else repair.SEEN if row in seen else repair.CUT if row[1] == "c" else 0
            seen.add(row)
            state.add(turn, row[0][0], fault, 1)
        assert state.result() == (0, *faults, illegal, cost, audit)


def test_long_conversation_is_streamed(spark):
    """A conversation far beyond a block, half of it out of order, beside short ones."""
    rows = [(1, i, "user" if i % 2 == i // 500 % 2 else "assistant", f"Turn {i}.") for i in range(3000)]
    rows += [(c, 0, "user", "Hi.") for c in range(2, 30)]
    table = spark.createDataFrame(rows, SCHEMA)
    plans = repair.plan(table).where("conv_id = 1").first()
    turns = repair.repaired(table, repair.plan(table)).where("conv_id = 1").orderBy("place").collect()
    initials = "".join(t.role[0] for t in turns)
    assert re.fullmatch("(ua)+", initials) and plans.cost == 18 and len(plans.audit) >= 3000
    assert [t.place for t in turns] == list(range(len(turns)))


def test_given_conversations(spark, sf_dir):
    table = read(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    short = {c for c in {r[0] for r in rows} if sum(r[0] == c for r in rows) <= 5}
    found = {r[0]: tuple(r)[1:] for r in repair.digest(table).collect()}
    assert found.keys() == {r[0] for r in rows}
    wanted = expected([r for r in rows if r[0] in short])
    assert {c: found[c] for c in wanted} == wanted
    assert repair.digest(table.limit(0)).collect() == []
