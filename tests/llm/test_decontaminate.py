"""Leaks against plain alignment and planted copies."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from hotdesk.llm import decontaminate
from hotdesk.llm.tables import read


def test_alignment_scores():
    rng = np.random.default_rng(0)
    for _ in range(60):
        item, window = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(1, 6, rng.integers(1, 20))
        assert decontaminate.local_scores(item, window[None, :])[0] == brute.local_score(item.tolist(), window.tolist())


def test_exact_passages(spark):
    folder = "/root/testdata/sf0.01"
    docs, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    items = {r.item_id: r.text for r in benchmark.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    planted = {(doc, item) for doc, text in texts.items() for item, own in items.items() if own in text}
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert found == planted and planted
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, benchmark).select("doc_id").collect()}
    assert kept == texts.keys() - {doc for doc, _ in found}


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_edited_copies(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    rng = random.Random(3)
    items = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(25, 60))] for _ in range(12)]
    docs, expected = [], set()
    for doc, item in enumerate(items):
        own = list(item)
        for _ in range(len(own) // 6):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], ["changed"], [own[at], "more"]])
        filler = [f"x{rng.randrange(900)}" for _ in range(300)]
        docs.append((doc, " ".join(filler[:150]) + ". " + ", ".join(own).upper() + " " + " ".join(filler[150:])))
        expected.add((doc, doc))
    docs += [(100 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(400))) for i in range(30)]
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.leaks(rows, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert {r.doc_id for r in decontaminate.without_leaks(rows, benchmark).collect()} == set(range(100, 130))


def test_edited_copies_of_near_equal_items(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(59)]
    items = [[*base[:i], f"own{i}", *base[i + 1 :]] for i in range(0, 56, 7)]
    docs = []
    for doc in range(40):
        own = [w if rng.random() > 0.3 else f"changed{rng.randrange(900)}" for w in base]
        docs.append((doc, " ".join([f"x{i}" for i in range(50)] + own + [f"y{i}" for i in range(50)])))
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    least = decontaminate.SIMILARITY * decontaminate.MATCH
    expected = {
        (doc, i) for doc, text in docs for i, t in enumerate(items)
        if brute.local_score(t, text.split()) >= least * len(t)
    }
    assert len(expected) > 200 and {(r.doc_id, r.item_id) for r in found} == expected


def test_passages_of_words_that_items_share(spark):
    """Items with just over half of their words their own: the shared rest alone is found too."""
    common = [f"c{i}" for i in range(27)]
    items = [[f"own{i}x{j}" for j in range(33)] + common for i in range(6)]
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(["a", *common, "b"])), (2, " ".join(common[:20]))], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.similarity) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert found == {(1, i, 0.45) for i in range(6)}


def test_recall_over_mixed_items(spark):
    """Of all pairs that plain alignment finds in cut and edited copies, at least 0.95 are found, and no others."""
    rng = random.Random(9)
    shared = [[f"s{k}w{i}" for i in range(30)] for k in range(3)]
    items = [
        [f"o{i}w{j}" for j in range(rng.randrange(5, 40))] + rng.choice(shared)[: rng.randrange(10, 31)] for i in range(40)
    ]
    docs = []
    for doc in range(160):
        own = list(rng.choice(items))
        low = rng.randrange(len(own) // 2)
        own = own[low : low + rng.randrange(len(own) // 3, len(own))]
        own = [w if rng.random() > 0.15 else f"edit{rng.randrange(900)}" for w in own]
        docs.append((doc, " ".join([f"x{i}" for i in range(40)] + own + [f"y{i}" for i in range(40)])))
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    rows = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    least = decontaminate.SIMILARITY * decontaminate.MATCH
    expected = {
        (doc, i) for doc, text in docs for i, t in enumerate(items)
        if brute.local_score(t, text.split()) >= least * len(t)
    }
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found <= expected and len(found) >= 0.95 * len(expected)


def test_short_items_are_left_out_by_parameter(spark):
    benchmark = spark.createDataFrame([(1, "Yes"), (2, "a longer one here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "fine day yes it is"), (2, "x a longer one here y")], "doc_id long, text string")
    kept = decontaminate.without_leaks(docs, benchmark, least_words=3).collect()
    assert [r.doc_id for r in kept] == [1]
    assert {r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()} == {1, 2}


def test_odd_rows(spark):
    items = [(1, "Alpha beta gamma delta epsilon zeta eta theta"), (2, "short one"), (3, ""), (4, None), (5, "uno")]
    benchmark = spark.createDataFrame([*items, (None, "x y z q")], "item_id long, text string")
    benchmark = benchmark.withColumn("item", F.lit(1))
    leak = "foo alpha, BETA gamma changed epsilon zeta eta theta bar"
    rows = [(1, leak), (1, leak), (2, None), (3, ""), (None, "a short one here"), (4, "uno")]
    docs = spark.createDataFrame([*rows, (5, "alpha beta gamma nothing else")], "doc_id long, text string")
    docs = docs.withColumn("m", F.lit(0)).withColumn("item", F.lit(2))
    found = sorted((r.doc_id or 0, r.item_id, r.similarity) for r in decontaminate.leaks(docs, benchmark).collect())
    assert found == [(0, 2, 1.0), (1, 1, 0.8125), (1, 1, 0.8125), (4, 5, 1.0)]
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert decontaminate.leaks(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.without_leaks(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate.leaks(docs.limit(0), benchmark).collect() == []
