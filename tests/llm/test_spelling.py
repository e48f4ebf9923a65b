"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from hotdesk.llm import spelling
from hotdesk.llm.tables import read

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans(spelling.CAPITALS, spelling.SMALL)


def apart(a: str, b: str) -> bool:
    """Whether one edit makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows: list[tuple]) -> dict:
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            counts[run if h % 97 else run[:at] + run[at + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    lists = defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            lists[word[:i] + "?" + word[i + 1 :]].add(word)
        for i in range(len(word) + 1):
            lists[word[:i] + "?" + word[i:]].add(word)
    near = defaultdict(set)
    for held in lists.values():
        for a in held:
            near[a] |= {b for b in held if apart(a, b)}
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        out[word] = (forms[word], root, n, len(near[word]), counts.get(forms[word]))
    return out


def result(rows) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


@pytest.mark.parametrize(("entries", "frequent", "size"), [(100_000, 16, 64), (30, 1, 3), (100_000, 1, 64), (10, 1, 1)])
def test_words_of_few_letters(spark, monkeypatch, entries, frequent, size):
    """Many near words, with dictionaries from none to full and lists that are all too long."""
    monkeypatch.setattr(spelling, "ENTRIES", entries)
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "LIST", size)
    rng = random.Random(entries + frequent)
    made = ["".join(rng.choices("abÀé", weights=[9, 5, 2, 1], k=rng.randint(4, 9))) for _ in range(500)]
    texts = [(rng.choice([i, None]), " ".join(rng.choices(made, k=60))) for i in range(150)]
    texts += [(1, None), (2, ""), (3, "×÷×÷×÷ " * 4), (4, "anana" * 300 + " 1 " + "anana" * 300 + "!" + "anana" * 300)]
    table = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "'y' AS id")
    assert result(spelling.digest(table)) == brute_force(texts)


def test_given_documents(spark, sf_dir):
    table = read(spark, sf_dir, "documents")
    expected = brute_force([tuple(r) for r in table.select("doc_id", "text").collect()])
    assert result(spelling.digest(table)) == expected
    assert sum(form is not None for form, *_ in expected.values()) > 20
    assert spelling.digest(table.limit(0)).collect() == []


def test_bounds_hold():
    """Of the grams that a word asks at least one is asked by every near word."""
    rng = random.Random(3)
    frequent = {"".join(rng.choices("ab$", k=rng.randint(2, 4))): rng.randint(2, 9) for _ in range(60)}
    for _ in range(3000):
        word = "".join(rng.choices("ab", k=rng.randint(5, 9)))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + "c" + word[at + 1 :], word[:at] + "b" + word[at:]])
        grams = [spelling.probed(w, frequent) for w in (word, other)]
        shift = len(other) - len(word)
        asked = {(p + s, g) for p, g in grams[0] for s in range(shift + 1)}
        assert asked & set(grams[1])
