"""Word hashes and the exact Jaccard join."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hotdesk.llm import ngram_join, words
from hotdesk.llm.components import components

TEXTS = ["A b  c\td", "a B c d", None, "", "  ", "x", "é É x y z", "a\x0bb\x0cc\rd\n", "a\x1cb c d", "word " * 100, "nO w"]


def families(seed: int) -> list[tuple]:
    """Families of edited copies of many sizes, with copies among them."""
    rng, texts = random.Random(seed), [None, None, "", "  ", "a", "A", "a b", "A b", "a b c"]
    for size in (4, 8, 12, 20, 40, 100, 300, 1000):
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for _ in range(rng.choice([2, 5, 25])):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + size // 12)):
                own[rng.randrange(size)] = f"w{rng.randrange(3000)}"
            texts += [" ".join(own)] * rng.choice([1, 1, 2])
    return list(enumerate(texts))


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_shingles_are_equal_where_words_are(size, monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 64)
    found = [set(s.tolist()) for s in words.shingle_sets(pa.array(TEXTS), size, words.Words())]
    expected = [brute.shingles(t, size) for t in TEXTS]
    assert [len(s) for s in found] == [len(s) for s in expected]
    for a, x in zip(found, expected, strict=True):
        for b, y in zip(found, expected, strict=True):
            assert len(a & b) == len(x & y)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 60)])
def test_join_finds_every_link(spark, monkeypatch, size, percent):
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    rows = families(size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("clash"))
    found = ngram_join.join(docs, size, percent).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == brute.near_copies(rows, size, percent)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_have_a_signature_in_common(percent):
    rng, bands, tried = np.random.default_rng(percent), ngram_join.Bands(percent), 0
    for size in [*range(1, 60), 100, 333, 1000]:
        for _ in range(20):
            base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            edits = rng.integers(0, max(1, size // 4) + 1)
            other = np.union1d(base[edits:], rng.integers(0, 2**64, edits, dtype=np.uint64))
            common = len(np.intersect1d(base, other))
            if edits and 100 * common >= percent * (len(base) + len(other) - common):
                tried += 1
                mine, theirs = bands.signatures(base), bands.signatures(other)
                _, i, j = np.intersect1d(mine[0], theirs[0], return_indices=True)
                level = (mine[0][i] & np.uint64(1)).astype(int)
                # On some level both have as many slices in common as either needs.
                assert any((level == x).sum() >= max(mine[1][i][level == x].max(initial=1),
                                                      theirs[1][j][level == x].max(initial=1)) for x in (0, 1))
    assert tried > 100


def test_sets_that_crowd_few_slices_still_meet():
    bands = ngram_join.Bands(90)
    base = np.arange(1, 101, dtype=np.uint64)  # all in the first slice
    other = base[1:]
    (mine, needs), (theirs, _) = bands.signatures(base), bands.signatures(other)
    assert len(np.intersect1d(mine, theirs)) >= needs.max()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 130)]
    star = [(7, i) for i in range(8, 40)]
    found = components(spark.createDataFrame([*chain, *star, (1, 1), (3, 2), (2, 3)], "a long, b long"))
    label = {r["node"]: r["component"] for r in found.collect()}
    assert label == {i: 100 for i in range(100, 131)} | {i: 7 for i in range(7, 40)} | {2: 2, 3: 2}


def test_one_document_of_each_group_stays(spark):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    rows = [(1, text), (1, text), (2, text + " q"), (None, text), (3, "other words here now then")]
    rows += [(3, "other words here now then"), (4, None), (4, None), (5, ""), (6, "solo")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("at", F.lit("x"))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 4, 5, 6]
    empty = docs.limit(0)
    assert ngram_join.keep_one(empty).collect() == ngram_join.digest(empty).collect() == []
