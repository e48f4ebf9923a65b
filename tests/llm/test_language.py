"""Prediction by partial matching against a plain version, and held-out accuracy."""

from __future__ import annotations

import zlib

import brute
import numpy as np

from hotdesk.llm import language_id
from hotdesk.llm.tables import read


def test_code_lengths(spark, monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", 16)
    train = {"xx": ["the cat sat on the mat", "then the hat"], "yy": ["der hund", "das haus äöü"], "zz": ["a"]}
    rows = spark.createDataFrame([(k, t) for k, v in train.items() for t in v], "lang string, text string")
    model = language_id.Model([tuple(r) for r in language_id.counts(rows).collect()])
    texts = [t.encode() for t in ["the hat", "das hund", "", "q", "äöü ñ zzz the", "the cat sat on" * 20]]
    symbols = len({b for v in train.values() for t in v for b in t.encode()}) + 1
    own = {name: [t.encode() for t in train[name]] for name in model.languages}
    expected = [[brute.code_length(own[name], t, symbols) for name in model.languages] for t in texts]
    assert np.allclose(model.lengths(texts), expected, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(lang)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) and 0 <= row.score <= 1
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in unseen) >= 0.98 * len(unseen)


def test_blocks_of_languages_learn_every_label(spark, monkeypatch):
    rows = []
    for k in range(6):
        own = "abcdefghijklmnopqrstuvwx"[4 * k : 4 * k + 4]
        rows += [(100 * k + i, " ".join([own, own[::-1]] * (i % 5 + 1)), f"l{k}") for i in range(10 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs).collect()}
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    found = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs).collect()}
    assert found == whole and {d: lang for d, (lang, _) in found.items()} == {d: lang for d, _, lang in rows}


def test_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string"
    given = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    odd = [(10**6, None, "en"), (10**6 + 1, "123 !!", "en"), (None, "the and of the", None), (10**6 + 2, "", None)]
    odd += [(10**6 + 3, "the on thing", "en")] * 2
    docs = given.unionByName(spark.createDataFrame(odd, schema))
    rows = [r for r in language_id.identify(docs).collect() if r.doc_id is None or r.doc_id >= 10**6]
    found = sorted((r.doc_id or 0, r.lang_pred) for r in rows)
    expected = [(0, "en"), (10**6, "und"), (10**6 + 1, "und"), (10**6 + 2, "und")] + [(10**6 + 3, "en")] * 2
    assert found == expected
    unlabelled = spark.createDataFrame([(1, "some words", None)], schema)
    assert [(r.lang_pred, r.score) for r in language_id.identify(unlabelled).collect()] == [("und", 0.0)]
    assert language_id.identify(unlabelled.limit(0)).collect() == []
