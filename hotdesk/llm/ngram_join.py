"""Exact Jaccard join of documents on word n-grams, by a token-group matrix.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct
shingles. Equal sets are one class from the start, so copies cost nothing further.

1. Which classes can link at all: a linked pair of sizes in one or two neighbouring size
   bands differs in at most D shingles. The hash space is cut into S > D slices; a slice that no
   difference touches has the same content in both, and at least S - D are untouched. Slices
   are hashed; a class that has fewer in common with the other classes, its empty slices
   allowed for, is done (pigeonhole: no link is lost).
2. The others are partitioned into groups of similar documents: those whose most widely shared
   slice is the same, in groups of bounded size. Each group keeps the union of its tokens.
3. A document queries the groups that share enough slices with it, and what of two groups
   queries the other meets in one task. Its overlap with the other group's union bounds its
   overlap with every member, so only groups that qualify are opened, and only qualifying
   documents are compared, as one product of token incidence matrices. Pairs never become rows: a task returns the links that join the
   two groups' own components.
4. Components of the links are found in rounds of joins.

Slices of an exact copy are made once per task; a slice shared by many is one row per class.

Defined results: a document without words has no shingles and links with nothing, not even
with its like; repeated rows have one class; NULL ids are passed over when the smallest id
of a component is taken; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.llm.components import components
from hotdesk.llm.tables import stored
from hotdesk.llm.words import Words, mixed, shingle_sets

#: About so many members and tokens has a group at most; tokens of an incidence matrix at a time;
#: classes that a task remembers.
GROUP, GROUP_TOKENS, TOKENS, REMEMBERED = 2048, 1 << 19, 2048, 1 << 20
#: Numbers that a task gathers before it hands them on.
HELD = 1 << 19
#: How often classes that share too little are left out, and with them what only they shared.
FILTERS = 2


def class_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


class Bands:
    """Size bands, and into how many slices the hash space is cut for a band and its next one."""

    def __init__(self, percent: int):
        self.percent = percent
        self.first, self.most = [1], []
        self._slices: dict[int, tuple[int, int]] = {}

    def band(self, size: int) -> int:
        while self.first[-1] <= size:
            self.most.append(self.first[-1] * 100 // self.percent)
            self.first.append(self.most[-1] + 1)
        return int(np.searchsorted(self.first, size, "right")) - 1

    def slices(self, band: int) -> tuple[int, int]:
        """Slices for pairs whose smaller set lies in ``band``, and the most differences of such a pair.

        Some slices more than differences, so that one untouched slice is not empty; a set
        with more empty ones than that names its empty slices too.
        """
        if band not in self._slices:
            self.band(self.first[band])
            size = self.most[band]
            differences = size * (100 - self.percent) // self.percent
            slices = differences + 1
            for _ in range(3):
                empty = slices * math.exp(-self.first[band] / slices)
                slices = differences + 1 + math.ceil(empty + 4 * math.sqrt(empty) + 1)
            self._slices[band] = (slices, differences) if differences else (0, 0)
        return self._slices[band]

    def signatures(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the slices of a sorted set, for pairs within its band and to either side, and beside
        each how many of its level a linked set has as well. The lowest bit tells the two levels apart."""
        band, found, needs = self.band(len(shingles)), [], []
        for level in (band - 1, band):
            slices, differences = self.slices(level) if level >= 0 else (0, 0)
            if not slices:
                continue
            slice_of = ((shingles >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
            begins = np.flatnonzero(np.append(True, slice_of[1:] != slice_of[:-1]))
            at = slice_of[begins]
            content = np.add.reduceat(mixed(shingles), begins)
            need = len(at) - differences  # untouched slices less empty ones
            if need < 1:
                empty = np.setdiff1d(np.arange(slices, dtype=np.uint64), at)
                at, content = np.append(at, empty), np.append(content, np.zeros(len(empty), np.uint64))
                need = 1  # the other set may not name its empty ones
            hashed = mixed(mixed(content + np.uint64(slices)) + at)
            found.append((hashed & ~np.uint64(1)) | np.uint64(level & 1))
            needs.append(np.full(len(at), need, np.int32))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int32)
        return np.concatenate(found), np.concatenate(needs)


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """Each row's set: class, size, and what finds the row again (its id and text hash)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            names, sizes = [], []
            for found in shingle_sets(batch.column("text"), shingle, words):
                names.append(class_of(found))
                sizes.append(len(found))
            columns = [batch.column("doc_id"), batch.column("at"), pa.array(names, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], ["doc_id", "at", "class", "size"])

    return docs.mapInArrow(work, "doc_id long, at long, class long, size long")


def _signatures(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Rows (signature, class, need); a class is named once per task, and again when many lie between."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bands, seen = Words(), Bands(percent), set()
        names, found, held = [], [], 0

        def rows() -> pa.RecordBatch:
            classes = np.repeat(np.array(names, np.int64), [len(hashes) for hashes, _ in found])
            hashes, needs = (np.concatenate(part) for part in zip(*found, strict=True))
            columns = [pa.array(hashes.view(np.int64)), pa.array(classes), pa.array(needs)]
            return pa.RecordBatch.from_arrays(columns, ["signature", "class", "need"])

        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), shingle, words):
                name = class_of(shingles)
                if not len(shingles) or name in seen:
                    continue
                seen.add(name)
                names.append(name)
                found.append(bands.signatures(shingles))
                held += len(found[-1][0])
                if held > HELD:
                    yield rows()
                    names, found, held = [], [], 0
            if len(seen) > REMEMBERED:
                seen.clear()
        if found:
            yield rows()

    return docs.select("text").mapInArrow(work, "signature long, class long, need int")


def _tokens(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows (class, tokens): the sorted set in binary form."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        names, found, held = [], [], 0

        def rows() -> pa.RecordBatch:
            columns = [pa.array(names, pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["class", "tokens"])

        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), shingle, words):
                names.append(class_of(shingles))
                found.append(shingles)
                held += len(shingles)
                if held > HELD:
                    yield rows()
                    names, found, held = [], [], 0
        if found:
            yield rows()

    return docs.select("text").mapInArrow(work, "class long, tokens binary")


def _placed(sets: list[np.ndarray], tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set and place in ``tokens`` of every token of the sets that is there, by place."""
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.searchsorted(tokens, every)
    at[at == len(tokens)] = 0
    there = np.flatnonzero(tokens[at] == every) if len(tokens) else at[:0]
    there = there[np.argsort(at[there], kind="stable")]
    return owner[there], at[there]


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of the left has in common with each of the right."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), True)
    out = np.zeros((len(left), len(right)), np.float32)
    sides = [(len(side), *_placed(side, shared)) for side in (left, right)]
    for low in range(0, len(shared), TOKENS):
        matrices = []
        for count, owner, at in sides:
            own = slice(*np.searchsorted(at, [low, low + TOKENS]))
            matrix = np.zeros((count, TOKENS), np.float32)
            matrix[owner[own], at[own] - low] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    return out.astype(np.int64)


def links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of the left link with which of the right.

    A set is compared only if its overlap with the other group's union lets it qualify.
    """
    out = np.zeros((len(left), len(right)), bool)

    def qualifying(queries: list[np.ndarray], group: list[np.ndarray]) -> np.ndarray:
        union = np.unique(np.concatenate(group))
        bound = np.array([np.isin(q, union, assume_unique=True).sum() for q in queries])
        return np.flatnonzero(100 * bound >= percent * np.array([len(q) for q in queries]))

    rows = qualifying(left, right)
    if not len(rows):
        return out
    columns = qualifying(right, [left[i] for i in rows])
    if not len(columns):
        return out
    common = overlaps([left[i] for i in rows], [right[i] for i in columns])
    sizes = np.array([len(left[i]) for i in rows])[:, None] + np.array([len(right[i]) for i in columns])
    out[np.ix_(rows, columns)] = 100 * common >= percent * (sizes - common)
    return out


def labels(linked: np.ndarray) -> np.ndarray:
    """The smallest reachable row of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label, len(label)).min(axis=1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _compare(percent: int):
    """A task's work on a pair of groups, or on a group by itself: links (a, b) between classes."""
    shape = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(table: pa.Table) -> pa.Table:
        names = table.column("class").to_numpy()
        _, first = np.unique(names, return_index=True)  # a row read twice has its class twice
        table, names = table.take(first), names[first]
        groups = table.column("group").to_numpy()
        sets = [np.frombuffer(t.as_py(), np.uint64) for t in table.column("tokens")]
        own = [np.flatnonzero(groups == g) for g in np.unique(groups)]
        label = [labels(links(s := [sets[i] for i in at], s, percent)) for at in own]
        if len(own) == 1:
            pairs = [(names[own[0][i]], names[own[0][r]]) for i, r in enumerate(label[0].tolist()) if i != r]
        else:
            between = links([sets[i] for i in own[0]], [sets[i] for i in own[1]], percent)
            met = {(int(label[0][i]), int(label[1][j])) for i, j in np.argwhere(between)}
            pairs = [(names[own[0][i]], names[own[1][j]]) for i, j in met]
        return pa.table({"a": [int(a) for a, _ in pairs], "b": [int(b) for _, b in pairs]}, schema=shape)

    return work


def _level() -> Column:
    return F.col("signature").bitwiseAND(1).alias("level")


def _with_enough(shared: DataFrame) -> DataFrame:
    """The rows of classes that share, at a level, as many slices as a link takes; only those slices that
    are still shared."""
    enough = shared.groupBy("class", _level()).agg(F.count("*").alias("have"), F.max("need").alias("need"))
    enough = enough.where("have >= need").select("class", "level")
    rows = shared.withColumn("level", _level()).join(enough, ["class", "level"], "left_semi").drop("level")
    several = rows.groupBy("signature").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return rows.join(several.where("low <> high"), "signature", "left_semi")


def class_links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between classes whose components are those of all links.

    ``docs``: doc_id, text, at. ``classes``: class, size, doc_id and at of one of its rows.
    """
    by_signature = Window.partitionBy("signature")
    shared = (
        _signatures(docs, shingle, percent)
        .withColumn("low", F.min("class").over(by_signature))
        .withColumn("high", F.max("class").over(by_signature))
        .withColumn("many", F.count("*").over(by_signature))
        .where("low <> high")
        .groupBy("signature", "class")
        .agg(F.max("many").alias("many"), F.max("need").alias("need"))
    )
    shared = stored(shared, "signatures")
    for _ in range(FILTERS):
        shared = stored(_with_enough(shared), "signatures")
    # The most widely shared slice brings nearly all of a family together.
    keyed = shared.groupBy("class").agg(F.max(F.struct("many", "signature"))["signature"].alias("key"))
    keyed = keyed.join(classes.select("class", "size"), "class")
    parts = F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(F.sum("size") / GROUP_TOKENS)).alias("parts")
    part = F.pmod(F.xxhash64("class"), F.col("parts"))
    grouped = keyed.join(keyed.groupBy("key").agg(parts), "key")
    groups = stored(grouped.select("class", F.xxhash64("key", part).alias("group")), "groups")
    # The members' sets: one row of each class that can link is read again.
    rows = groups.join(classes.select("class", "doc_id", "at"), "class").select("doc_id", "at").hint("shuffle_hash")
    again = docs.join(rows, (docs["at"] == rows["at"]) & docs["doc_id"].eqNullSafe(rows["doc_id"]), "left_semi")
    members = stored(_tokens(again, shingle).join(groups, "class"), "members")
    # Of two groups those members meet that share enough slices with the other; a group meets itself whole.
    named = shared.join(groups, "class").select("signature", "class", "group", "need")
    other = named.select("signature", F.col("group").alias("other")).distinct()
    pair = F.xxhash64(F.least("group", "other"), F.greatest("group", "other")).alias("pair")
    asked = named.join(other, "signature").where("group <> other").groupBy("class", "group", "other", _level())
    enough = asked.agg(F.count("*").alias("have"), F.max("need").alias("need")).where("have >= need")
    sides = enough.select(pair, "class").distinct()
    alone = groups.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    sides = sides.unionByName(groups.join(alone, "group", "left_semi").select(F.col("group").alias("pair"), "class"))
    met = sides.join(members, "class").select("pair", "group", "class", "tokens")
    return met.groupBy("pair").applyInArrow(_compare(percent), "a long, b long")


def join(docs: DataFrame, shingle: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class and component (smallest class reachable),
    ``component_id`` (the smallest doc_id reachable by links) and ``at`` (hash of the text)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("at"))
    rows = stored(_sets(docs, shingle), "sets")
    worded = rows.where("size > 0")
    classes = worded.groupBy("class").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "at")).alias("row"), F.first("size").alias("size")
    )
    classes = stored(classes.select("class", "size", "least", "row.doc_id", "row.at"), "classes")
    linked = components(class_links(docs, classes, shingle, percent))
    found = classes.join(linked.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "least", F.coalesce("component", "class").alias("component")
    )
    several = found.join(linked.select("component").distinct(), "component", "left_semi")
    least = several.groupBy("component").agg(F.min("least").alias("of_all"))
    named = found.join(least, "component", "left").select(
        "class", "component", F.coalesce("of_all", "least").alias("component_id")
    )
    bare = rows.where("size = 0").select(
        "doc_id", F.col("size").alias("n_shingles"), "class", F.lit(None).cast("long").alias("component"),
        F.col("doc_id").alias("component_id"), "at",
    )
    return (
        worded.join(named, "class")
        .select("doc_id", F.col("size").alias("n_shingles"), "class", "component", "component_id", "at")
        .unionByName(bare)
    )


def digest(docs: DataFrame) -> DataFrame:
    """Documents linked at 90 percent of their 3-word shingles."""
    return join(docs, shingle=3, percent=90).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id") -> DataFrame:
    """The documents without near copies: of every component one row, that of the smallest id, stays.

    Documents without words link with nothing and are all kept. All columns stay.
    """
    found = join(docs, shingle, percent, doc_id)
    worded = found.where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at", "n_shingles")).alias("first")
    kept = worded.groupBy("component").agg(first).select("first.doc_id", "first.at")
    kept = kept.unionByName(found.where("component IS NULL").select("doc_id", "at")).distinct()

    def place(row_id, at) -> list:
        return [at.alias("at__"), F.coalesce(row_id.cast("string"), F.lit("")).alias("id__")]

    kept = kept.select(*place(F.col("doc_id"), F.col("at"))).distinct().hint("shuffle_hash")
    rows = docs.select(F.struct("*").alias("row__"), *place(F.col(doc_id), F.xxhash64("text")))
    # A row that stands in the table twice stays once; the join has brought its copies together.
    same = Window.partitionBy("at__", "id__").orderBy(F.lit(0))
    rows = rows.join(kept, ["at__", "id__"], "left_semi").withColumn("copy__", F.row_number().over(same))
    worded_once = (F.col("copy__") == 1) | ~F.coalesce(F.col("row__.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return rows.where(worded_once).select("row__.*")
