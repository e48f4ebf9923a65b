"""Token ids, packing and matrices: exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hotdesk.llm import packing, token_output, tokens
from hotdesk.llm.tables import read

ODD = ["a" * 5000, " " * 9000, "日本" * 3000, "\n" * 999 + "x", " ½²Ⅷ x", "it's we'LL  <|endoftext|> \x1c \x85 　 x", "\x00\x01"]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: (tokenizer.encode(text, add_special_tokens=False).ids if text else []) + [0]


@pytest.fixture(scope="module")
def docs(spark):
    made = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "ab c " * 40000), (10**6 + 3, "x")]
    made += [(10**6 + 10 + i, t) for i, t in enumerate(ODD)]
    given = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = given.unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    return rows.withColumn("ids", F.lit("clash")).cache()


def test_ids_are_those_of_the_named_vocabulary(reference, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 50)
    encode = tokens.encoder()
    for text in [*ODD, "Some words, more words don't end here.\nNew line " * 20, None, ""]:
        assert encode(text).tolist() == reference(text)


def test_the_special_token_is_one_id(reference, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 20)
    mark, encode = "<|endoftext|>", tokens.encoder()
    texts = [mark, f"{mark}{mark}", f"Hello, {mark} there", f"{mark} x", f"x  {mark}", f"a b {mark}  {mark}\n{mark}"]
    texts += ["many words " * n + mark + " more words" * 5 for n in range(1, 6)]  # at the edges of blocks
    for text in texts:
        assert encode(text).tolist() == reference(text) and 50256 in encode(text)
    assert 50256 not in tokens.encoder(special={})(mark).tolist()


def test_every_id_lies_in_one_piece(docs, reference):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in packing.digest(docs).collect():
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    total = 0
    for doc in docs.collect():
        ids, at = reference(doc.text), 0
        for row in sorted(pieces.pop(doc.doc_id), key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            own = np.array(ids[at : at + row.length], "<u4")
            assert zlib.crc32(own.tobytes()) == row.ids_crc32
            at += row.length
        assert at == len(ids)
        total += at
    assert not pieces
    for rows in sequences.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= packing.LENGTH
    partitions = docs.rdd.getNumPartitions()
    assert len(sequences) * packing.LENGTH < total + partitions * packing.LENGTH


def test_costs_are_balanced_under_capacity():
    sizes = np.random.default_rng(0).integers(1, 1024, 400)
    cost, used = defaultdict(float), defaultdict(int)
    for _, _, take, sequence in packing.balanced(sizes, 1024, 1.0, 1 / 1024):
        cost[sequence] += take + take * take / 1024
        used[sequence] += take
    assert len(used) == -(-sizes.sum() // 1024) and max(used.values()) <= 1024
    assert sum(used.values()) == sizes.sum()
    # The highest cost is a sequence of one long piece; dealing by size alone would not come near it.
    assert max(cost.values()) <= 2048


def test_matrices_give_every_document_back(docs, reference):
    back = defaultdict(dict)
    for row in token_output.matrices(docs).collect():
        ids, positions = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.positions, "<u2")
        assert len(ids) == len(positions) == token_output.WIDTH and row.cu_seqlens[-1] == row.n_tokens
        assert not ids[row.n_tokens :].any() and not positions[row.n_tokens :].any()
        for i, (doc, start) in enumerate(zip(row.doc_ids, row.doc_starts, strict=True)):
            low, high = row.cu_seqlens[i : i + 2]
            assert (positions[low:high] == np.arange(high - low)).all()
            back[doc][start] = ids[low:high]
    for doc in docs.collect():
        parts = back.pop(doc.doc_id)
        assert np.concatenate([parts[s] for s in sorted(parts)]).tolist() == reference(doc.text)
    assert not back


def test_best_fit_takes_the_tightest_row():
    sizes = np.random.default_rng(1).integers(1, 101, 300).tolist()
    rows, rooms = [], []
    for size in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - size)
        else:
            rooms.append(100 - size)
    for row in token_output.best_fit(sizes, 100):
        rows.append(100 - sum(sizes[i] for i in row))
    assert sorted(rows) == sorted(rooms) and min(rows) >= 0


def test_empty_table(docs):
    assert packing.digest(docs.limit(0)).collect() == []
    assert token_output.matrices(docs.limit(0)).collect() == []
