"""Benchmark leaks: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are runs of letters and digits in lower case. Every item of the benchmark names its
n-grams that few items share as seeds, and in every stretch of it at least the ``LEAST`` rarest
ones (all, where fewer than half of the stretch are so rare, as in groups of near-equal items).
A passage that can reach the least similarity holds a whole stretch, so seeds are found wherever it is cut
out; a passage kept word for word is never missed, an edited one only where the
edits leave less than two seeds. Where at least two
seeds of an item, or all it has, lie in a document at about the distance they have in the
item, the words around are aligned with the item; copies with words changed, dropped or
inserted keep most of the score. ``similarity`` is the best local score over that of the
item against itself.

The benchmark is read in blocks of bounded size that travel to the tasks; every document is
scanned whole against each block. Nothing of the corpus is shuffled or collected.

Defined results: NULL and empty texts match nothing; items without words match nothing; items
of fewer than ``GRAM`` words have themselves as their only seed, and items of fewer than
``least_words`` match nothing (an item "Yes" would match most of a corpus); repeated rows match
each on its own; equal items match both.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hotdesk.llm.tables import stored
from hotdesk.llm.words import SIGNS, Words, grams, portions

#: Words of a seed, items that may share it, seeds every stretch keeps, words of a block of items.
GRAM, RARE, LEAST, BLOCK = 3, 4, 8, 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least similarity of a leak; alignments that are computed together.
SIMILARITY, TOGETHER = 0.4, 256

MATCHES = "array<struct<item: bigint, similarity: double, seeds: bigint, first_word: bigint, last_word: bigint>>"


class Items(NamedTuple):
    """A block of items: words one after the other, and the sorted seeds with their item and place."""

    ids: np.ndarray
    words: np.ndarray
    bounds: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_place: np.ndarray
    seed_count: np.ndarray


def stretch(words: int, least: float) -> int:
    """N-grams of a stretch: any passage of an item that can reach the similarity holds a whole one.

    ``least`` of the words must match, so the passage has at least as many n-grams less
    ``GRAM`` - 1; stretches of half of that lie whole in it wherever it begins.
    """
    return max(1, (int(np.ceil(least * words)) - GRAM + 2) // 2)


def seeds(benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Rows (item, at, gram, place): the seeds of each item; ``at`` tells rows of one id apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(SIGNS)
        for batch in batches:
            hashes, bounds = words.of(batch.column("text"))
            for row, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                found = grams(hashes[low:high], min(GRAM, high - low)) if high > low else hashes[:0]
                item, at = (pa.array([batch.column(n)[row].as_py()] * len(found), pa.int64()) for n in ("item", "at"))
                place = np.arange(len(found))
                own = place // stretch(int(high - low), least)
                columns = [item, at, pa.array(found.view(np.int64)), pa.array(place), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "at", "gram", "place", "stretch"])

    every = benchmark.select("item", "at", "text").mapInArrow(
        work, "item long, at long, gram long, place long, stretch long"
    )
    by_gram = every.groupBy("gram").agg(F.count_distinct("item", "at").alias("items"))
    own = Window.partitionBy("item", "at", "stretch")
    ranked = every.join(by_gram, "gram").withColumn("rank", F.row_number().over(own.orderBy("items", "gram", "place")))
    rare = F.col("items") <= RARE
    ranked = ranked.withColumn("few", 2 * F.count(F.when(rare, 1)).over(own) < F.count("*").over(own))
    return ranked.where(rare | (F.col("rank") <= LEAST) | F.col("few")).select("item", "at", "gram", "place")


def blocks(
    benchmark: DataFrame, item_id: str, text: str, least: float = SIMILARITY, least_words: int = 1
) -> Iterator[Items]:
    """The benchmark in blocks of about ``BLOCK`` words, without items of fewer than ``least_words`` words."""
    items = benchmark.select(
        F.col(item_id).cast("long").alias("item"), F.lower(text).alias("text"), F.xxhash64(text).alias("at")
    )
    items = stored(items.where("item IS NOT NULL AND text IS NOT NULL").distinct(), "benchmark")
    found = stored(seeds(items, least), "seeds")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (8 * BLOCK)))
    for block in range(count):
        own = F.pmod(F.xxhash64("item", "at"), F.lit(count)) == block
        texts = items.where(own).orderBy("item", "at").collect()
        if not texts:
            continue
        row = {(r["item"], r["at"]): i for i, r in enumerate(texts)}
        words, bounds = Words(SIGNS).of(pa.array([r["text"] for r in texts], pa.string()))
        listed = sorted((r["gram"], row[r["item"], r["at"]], r["place"]) for r in found.where(own).collect())
        listed = [seed for seed in listed if bounds[seed[1] + 1] - bounds[seed[1]] >= least_words]
        columns = np.array(listed, np.int64).reshape(-1, 3)
        gram = columns[:, 0].view(np.uint64)
        order = np.argsort(gram, kind="stable")
        yield Items(
            np.array([r["item"] for r in texts], np.int64), words, bounds,
            gram[order], columns[order, 1], columns[order, 2],
            np.bincount(columns[:, 1], minlength=len(texts)),
        )


def local_scores(item: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of the item with each row of ``windows`` (0 matches nothing)."""
    steps = np.arange(windows.shape[1] + 1) * -GAP
    before = np.zeros((len(windows), windows.shape[1] + 1))
    best = np.zeros(len(windows))
    for word in item:
        now = np.zeros_like(before)
        now[:, 1:] = before[:, :-1] + np.where(windows == word, MATCH, MISMATCH)
        np.maximum(now, before + GAP, out=now)
        np.maximum(now, 0, out=now)
        # Gaps along the window: the best earlier cell less a step for each word between.
        now = np.maximum.accumulate(now + steps, axis=1) - steps
        best = np.maximum(best, now.max(axis=1))
        before = now
    return best


def _candidates(items: Items, table: np.ndarray, every: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (text, item, first word, word after the last, seeds) where seeds of an item lie together."""
    at = np.flatnonzero(table[(every & np.uint64(len(table) - 1)).astype(np.int64)])
    low = np.searchsorted(items.seeds, every[at], "left")
    count = np.searchsorted(items.seeds, every[at], "right") - low
    at, low, count = at[count > 0], low[count > 0], count[count > 0]
    if not len(at):
        return np.zeros((0, 5), np.int64)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    posting = np.repeat(low, count) + nth
    at = np.repeat(at, count)
    text = np.searchsorted(bounds, at, "right") - 1
    item, place = items.seed_item[posting], items.seed_place[posting]
    length = np.diff(items.bounds)[item]
    begin = at - place  # where the item would begin
    order = np.lexsort((at, begin, item, text))
    text, item, begin, length, at, place = (x[order] for x in (text, item, begin, length, at, place))
    slack = length // 4 + 4
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(text))
    # Different places of the item that occur, not how often one of them does.
    group = np.cumsum(fresh) - 1
    pairs = np.unique(group * (int(place.max()) + 1) + place)
    places = np.bincount(pairs // (int(place.max()) + 1), minlength=len(starts))
    enough = places >= np.minimum(2, items.seed_count[item[starts]])
    starts, ends, places = starts[enough], ends[enough], places[enough]
    first = np.maximum(begin[starts] - slack[starts], bounds[text[starts]])
    last = np.minimum(begin[ends - 1] + length[starts] + slack[starts], bounds[text[starts] + 1])
    return np.column_stack([text[starts], item[starts], first, last, places])


def find(items: Items, words: np.ndarray, bounds: np.ndarray, least: float) -> list[list[dict]]:
    """The leaks in each text: one per item, by its best passage."""
    out: list[list[dict]] = [[] for _ in bounds[1:]]
    table = np.zeros(1 << 22, bool)
    table[(items.seeds & np.uint64(len(table) - 1)).astype(np.int64)] = True
    # Runs of fewer words are the seeds of items that are as short.
    sizes = np.unique(np.minimum(np.diff(items.bounds), GRAM))
    found = [_candidates(items, table, grams(words, size), bounds) for size in sizes[sizes > 0].tolist()]
    if not found:
        return out
    rows = np.concatenate(found)
    rows = rows[rows[:, 3] > rows[:, 2]]
    if not len(rows):
        return out
    rows = rows[np.lexsort((rows[:, 2], rows[:, 3] - rows[:, 2], rows[:, 1]))]
    scores = np.zeros(len(rows))
    lengths = np.diff(items.bounds)
    begin = 0
    while begin < len(rows):
        item = rows[begin, 1]
        end = min(int(np.searchsorted(rows[:, 1], item, "right")), begin + TOGETHER)
        width = int((rows[begin:end, 3] - rows[begin:end, 2]).max())
        windows = np.zeros((end - begin, width), np.uint64)
        for window, (_, _, first, last, _) in zip(windows, rows[begin:end], strict=True):
            window[: last - first] = words[first:last]
        own = items.words[items.bounds[item] : items.bounds[item + 1]]
        scores[begin:end] = local_scores(own, windows) / (MATCH * lengths[item])
        begin = end
    best: dict[tuple[int, int], tuple] = {}
    for (text, item, first, last, places), similarity in zip(rows.tolist(), scores.tolist(), strict=True):
        if similarity >= least:
            low = int(bounds[text])
            leak = (similarity, places, first - low, last - low)
            best[text, item] = max(leak, best.get((text, item), leak))
    for (text, item), (similarity, places, first, last) in sorted(best.items()):
        out[text].append(
            {"item": int(items.ids[item]), "similarity": similarity, "seeds": places, "first_word": first,
             "last_word": last}
        )
    return out


def matcher(items: Items, least: float):
    """A column function: the leaks in a text."""
    shape = pa.list_(
        pa.struct(
            [("item", pa.int64()), ("similarity", pa.float64())]
            + [(name, pa.int64()) for name in ("seeds", "first_word", "last_word")]
        )
    )

    @F.arrow_udf(MATCHES)
    def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(SIGNS)
        for texts in batches:
            found = []
            for rows in portions(texts):
                found += find(items, *words.of(texts[rows]), least)
            yield pa.array(found, shape)

    return matches


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", least: float = SIMILARITY, least_words: int = 1,
) -> DataFrame:
    """A row per document row and item that leaks into it: doc_id, item_id, similarity, seeds and the words
    (from 0, end exclusive) that were aligned."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.lower(text).alias("text"))
    out = rows.select("doc_id", F.lit(None).cast(MATCHES).alias("m")).where("false")
    for items in blocks(benchmark, item_id, item_text, least, least_words):
        out = out.unionByName(rows.select("doc_id", matcher(items, least)("text").alias("m")))
    return out.select("doc_id", F.explode("m").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), "m.similarity", "m.seeds", "m.first_word", "m.last_word"
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    least: float = SIMILARITY, least_words: int = 1,
) -> DataFrame:
    """The documents into which no item leaks, with all columns.

    Further blocks of a large benchmark go over what the one before left, written to the shared folder.
    """
    for i, items in enumerate(blocks(benchmark, item_id, item_text, least, least_words)):
        rows = (stored(docs, "clean") if i else docs).select(F.struct("*").alias("doc"))
        found = matcher(items, least)(F.lower(F.col(f"doc.{text}")))
        docs = rows.select("doc", found.alias("m")).where(F.size("m") == 0).select("doc.*")
    return docs
