"""Shards of equal counts that keep groups together."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from hotdesk.llm import numbering, sharding
from hotdesk.llm.tables import read

from pyspark.sql import functions as F


def check(docs, shards: int, most_split: int) -> None:
    given = docs.collect()
    rows = sharding.digest(docs, shards).collect()
    facts = [(d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in given]
    assert Counter(facts) == Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)
    slots = defaultdict(list)
    for row in rows:
        assert row.law == "rows" and row.grown_shard is None and 0 <= row.shard < shards
        slots[row.shard].append(row.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes = defaultdict(set)
    for row in rows:
        if row["size"] > 1:
            homes[row.text_crc32].add(row.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= most_split


def test_given_documents(spark, sf_dir):
    check(read(spark, sf_dir, "documents"), 16, 0)


@pytest.mark.parametrize("shards", [3, 16])
def test_hot_group_of_a_third_of_the_rows(spark, shards):
    texts = ["hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"own {i}" for i in range(240)]
    rows = [*enumerate(texts), (900, None), (901, None), (902, ""), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("group", F.lit("clash"))
    # The hot group must be cut, no other.
    check(docs, shards, 1 if shards > 3 else 0)


def test_only_copies_and_no_rows(spark):
    check(spark.createDataFrame([(i, "same") for i in range(40)], "doc_id long, text string"), 3, 1)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.digest(empty).collect() == []


def test_running_sums_in_parts(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(7)).alias("p"))
    found = numbering.running_before(rows, ["g"], "p", ["id"], F.col("id"), "before").collect()
    for row in found:
        assert row.before == sum(r.id for r in found if r.g == row.g and (r.p, r.id) < (row.p, row.id))


def test_native_plan(spark, sf_dir):
    plan = sharding.digest(read(spark, sf_dir, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def cut_pairs(labels: dict[int, int], hubs: dict[int, int]) -> int:
    rows = sorted(labels)
    return sum(hubs[a] == hubs[b] and labels[a] != labels[b] for a in rows for b in rows if a < b)


def least_cut(sizes: list[int], quota: tuple[int, ...]) -> int:
    """The fewest cut pairs of any placement of groups of these sizes, all placements tried."""
    if not sizes:
        return 0

    def splits(n: int, rooms: tuple[int, ...]):
        if len(rooms) == 1:
            if n <= rooms[0]:
                yield (n,)
            return
        for here in range(min(n, rooms[0]) + 1):
            for rest in splits(n - here, rooms[1:]):
                yield (here, *rest)

    size, others = sizes[0], sizes[1:]
    return min(
        (size**2 - sum(n * n for n in split)) // 2 + least_cut(others, tuple(q - n for q, n in zip(quota, split)))
        for split in splits(size, quota)
    )


@pytest.mark.parametrize(
    "sizes, shards, alone, times",
    # A hub that no shard can hold may end in a local optimum.
    [([2, 2, 2, 2], 2, 0, 1), ([3, 2, 2], 3, 5, 1), ([4, 4, 4], 3, 0, 1), ([7, 2], 4, 7, 1), ([6, 2, 2], 3, 4, 2)],
)
def test_rounds_lower_the_cut_as_far_as_the_best_of_all_placements(spark, sizes, shards, alone, times):
    hubs = {row: hub for row, hub in enumerate(h for h, n in enumerate(sizes) for _ in range(n))}
    quota = sharding.quotas(len(hubs) + alone, shards)
    edges = spark.createDataFrame(list(hubs.items()), "row long, hub string")
    cuts = []
    for state, cut, load in sharding.rounds(sharding.start(edges, shards), quota):
        labels = {r["row"]: r["shard"] for r in state.collect()}
        assert labels.keys() == hubs.keys()
        assert load == [sum(at == s for at in labels.values()) for s in range(shards)]
        assert all(n <= most for n, most in zip(load, quota, strict=True))
        assert cut == cut_pairs(labels, hubs)
        cuts.append(cut)
    assert all(a > b for a, b in zip(cuts, cuts[1:])) and len(cuts) > 1
    assert cuts[-1] <= times * least_cut(sizes, tuple(quota))


def test_columns_of_the_operator_s_own_names_are_kept(spark):
    names = ["hub", "to", "part", "part__", "weight__", "held", "number", "all", "size", "given", "before", "lane"]
    columns = ", ".join(f"{name} string" for name in names)
    docs = spark.createDataFrame(
        [(i, f"g{i // 2}", *names) for i in range(12)], f"row long, group string, {columns}"
    )
    found = sharding.shard(docs, 3)
    assert found.columns == [*docs.columns, "shard", "slot"]
    assert all(row[2:-2] == tuple(names) for row in found.collect())
