"""Reply trees: paths against a plain walk, formatting against an exact round trip."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from hotdesk.llm import reply_trees
from hotdesk.llm.tables import read

ODD = ["", None, "\\", "##", "###", "####", "</turn>", "<\\/turn>", "\\### Assistant: </turn> ok", "a\n### user: b</turn>\n", "é😀#"]


def branches_of(links: list[tuple], keep: int) -> dict:
    parents = {(t, n): p for t, n, p, _ in links}
    scores = {(t, n): s or 0 for t, n, _, s in links}
    up = {k: p if (k[0], p) in parents else None for k, p in parents.items()}
    inner = {(t, p) for (t, _), p in up.items() if p is not None}
    found = defaultdict(list)
    for tree, node in parents:
        if (tree, node) in inner:
            continue
        path, at = [], node
        while at is not None and len(path) <= len(links):
            path.append(at)
            at = up[tree, at]
        if at is None:
            found[tree].append((-sum(scores[tree, n] for n in path), node, path[::-1]))
    return {t: [p for *_, p in sorted(b)[:keep]] for t, b in found.items()}


@pytest.fixture(scope="module")
def links():
    rng = random.Random(1)
    rows = []
    for tree in [*range(20), None]:
        nodes = rng.sample(range(100), rng.randint(1, 40))
        for i, node in enumerate(nodes):
            parent = rng.choice([nodes[i - 1], *nodes[:i]]) if i and rng.random() < 0.97 else rng.choice([None, 777])
            rows.append((tree, node, parent, rng.choice([None, 1.0, 2.0, -1.0])))
    rows += [(50, i, i - 1 if i else None, 0.5) for i in range(300)]  # a long chain
    rows += [(60, 1, 2, 1.0), (60, 2, 1, 1.0), (60, 3, 2, 1.0), (60, 4, None, 1.0)]  # a circle and a tail
    rows += [(70, i, 0 if i else None, float(i % 7)) for i in range(200)]  # a star
    return rows


def test_paths_are_the_best_branches(spark, links):
    table = spark.createDataFrame(links, "tree long, node long, parent long, score double")
    table = table.selectExpr("*", "'x' AS up", "1 AS depth", "2 AS leaf")
    found = defaultdict(dict)
    for row in reply_trees.paths(table, 3).collect():
        assert row.place not in found.setdefault((row.tree, row.rank), {})
        found[row.tree, row.rank][row.place] = row.node
    got = defaultdict(list)
    for (tree, rank), path in sorted(found.items(), key=lambda kv: (str(kv[0][0]), kv[0][1])):
        assert sorted(path) == list(range(len(path))) and rank == len(got[tree]) + 1
        got[tree].append([path[i] for i in range(len(path))])
    assert got == branches_of(links, 3)
    assert reply_trees.paths(table.limit(0), None).collect() == []


def test_branches_are_formatted_and_read_back(spark, links, monkeypatch):
    monkeypatch.setattr(reply_trees, "PART", 16)
    monkeypatch.setattr(reply_trees, "CHARACTERS", 100)
    rng = random.Random(2)
    texts = {(t, n): (rng.choice(["user", "assistant", "a:b\\", None, "#"]), rng.choice(ODD)) for t, n, *_ in links}
    table = spark.createDataFrame(links, "tree long, node long, parent long, score double")
    said = spark.createDataFrame([(*k, *v) for k, v in texts.items()], "tree long, node long, role string, text string")
    rows = reply_trees.formatted(table, said, 2).collect()
    rows.sort(key=lambda r: (str(r.tree), r.rank, r.part, r.piece))
    got = defaultdict(list)
    for row in rows:
        own = [(role, row.text[a:b]) for role, a, b in reply_trees.turns(row.text)]
        got[row.tree, row.rank] += [(role, reply_trees.unescaped(text)) for role, text in own]
        assert [row.text[s.start : s.end] for s in row.loss] == [text for role, text in own if role == "assistant"]
    wanted = {
        (tree, rank): [(texts[tree, n][0] or "", texts[tree, n][1] or "") for n in path]
        for tree, paths in branches_of(links, 2).items()
        for rank, path in enumerate(paths, 1)
    }
    assert got == wanted


def test_conversations_come_back(spark, sf_dir):
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rng = random.Random(3)
    made = [(10**6 + i % 9, rng.choice([0, 1, 5000, None]), rng.choice(["user", "assistant", None]), rng.choice(ODD)) for i in range(60)]
    made += [(None, 0, "user", "x"), *[(10**7, 0, "assistant", "again")] * 5]
    table = given.unionByName(spark.createDataFrame(made, given.schema)).selectExpr("*", "1 AS tree", "2 AS node")
    told = "\\### Assistant: </turn> ok"
    kept = defaultdict(list)
    for conv, turn, role, text in [*map(tuple, table.drop("tree", "node").collect()), (-7, 0, "user", told), (-7, 1, "assistant", told)]:
        kept[conv].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    found = {r.conv_id: r for r in reply_trees.digest(table).collect()}
    assert found.keys() == kept.keys()
    for conv, rows in kept.items():
        row = found[conv]
        assert row.n_turns == len(rows)
        learnt = sorted(r[4] for r in rows if r[3] == "assistant")
        assert row.loss_chars == sum(map(len, learnt))
        if len({r[:2] for r in rows}) == len(rows):  # no ties
            rows.sort()
            both = "".join(f"{r[3]}\n{r[4]}\n" for r in rows)
            assert row.turns_sha256 == hashlib.sha256(both.encode()).hexdigest()
            learnt = "".join(r[4] for r in rows if r[3] == "assistant")
            assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert [r.conv_id for r in reply_trees.digest(table.limit(0)).collect()] == [-7]
