"""Chat formatting of reply trees: every root-to-leaf path is a branch, the best become conversations.

Links (tree, node, parent) are turned into paths by self-joins that double their reach: after
round k a node knows its ancestor 2^k steps up and the score gathered on the way, so a tree of
depth d needs log2(d) rounds, and rows of ids alone. Leaves then know the score of their whole
path; each tree keeps its best branches. Their nodes are listed by the same tables in turn:
distances below 2^(k+1) are those below 2^k and those plus 2^k, so each ancestor comes once.

Turns are written as ``### role: text</turn>`` and a line feed. Inside roles and texts a
backslash is doubled, and one is put into ``##`` and ``</turn>`` (and before a colon of a role),
so no control string is left there; :func:`unescaped` takes them out again. A path is written
in parts of at most ``PART`` nodes and about ``CHARACTERS`` characters, cut between turns;
joined in order they are the conversation. Parts are made in tasks of their own, so a path
that holds a large share of all rows is spread. Each part has the spans of the text to be
learnt from (the assistant's), in code points.

Defined results: a parent that is not in its tree counts as none; nodes that hang on a circle
are in no path; equal scores go by the leaf; a NULL score counts as 0; NULL text or role is
empty; a node that is given several times is said as often, ``times`` in all; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hotdesk.llm.batches import in_batches, records
from hotdesk.llm.tables import stored

PART, CHARACTERS = 1024, 1 << 20
BRANCHES = 4
ASSISTANT = "assistant"
OPENING, COLON, CLOSING = "### ", ": ", "</turn>"
#: Turns that are looked at together to find the row before.
STRETCH = 1024


# ---- paths ---------------------------------------------------------------------


def _jumps(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up) of the ancestors 1, 2, 4 ... steps up, and (tree, node, depth, score) of all nodes."""
    known = links.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    valid = links.join(
        known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left"
    )
    rows = stored(
        valid.select(
            "tree", "node", F.col("n").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("sum")
        ),
        "jumps",
    )
    count, tables = rows.count(), []
    done, open_ = [rows.where("up IS NULL")], rows.where("up IS NOT NULL")
    # Who still has an ancestor beyond as many steps as there are nodes hangs on a circle.
    while len(tables) <= count.bit_length() and not open_.isEmpty():
        tables.append(open_.select("tree", "node", "up"))
        # Only nodes that have not reached their root go on, so deep trees alone take many rounds.
        low, high = open_.alias("l"), reduce(DataFrame.unionByName, done, open_).alias("h")
        same = F.col("l.tree").eqNullSafe(F.col("h.tree")) & (F.col("l.up") == F.col("h.node"))
        rows = stored(
            low.join(high, same).select(
                "l.tree",
                "l.node",
                "h.up",
                (F.col("l.depth") + F.col("h.depth")).alias("depth"),
                (F.col("l.sum") + F.col("h.sum")).alias("sum"),
            ),
            "jumps",
        )
        done, open_ = [*done, rows.where("up IS NULL")], rows.where("up IS NOT NULL")
    return tables, reduce(DataFrame.unionByName, done).select("tree", "node", "depth", F.col("sum").alias("score"))


def paths(links: DataFrame, branches: int | None = BRANCHES) -> DataFrame:
    """The nodes of the best branches of each tree: tree, leaf, rank (from 1), place (from 0), node.

    ``links`` has tree, node, parent and, where it is known, score; a branch's score is the sum
    over its nodes. Without a number of branches all are kept, and have no rank.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)) if "score" in links.columns else F.lit(0.0)
    links = stored(
        links.select("tree", "node", "parent", score.alias("score")).dropDuplicates(["tree", "node"]), "links"
    )
    tables, nodes = _jumps(links)
    if tables:
        parents = tables[0].select(F.col("tree").alias("t"), F.col("up").alias("n"))
        leaves = nodes.join(
            parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti"
        )
    else:
        leaves = nodes
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    if branches is None:
        leaves = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        leaves = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    found = leaves.select(
        "tree", F.col("node").alias("leaf"), "rank", (F.col("depth") - 1).alias("place"), "node"
    )
    if tables:
        found = stored(found, "paths")
    for k, table in enumerate(tables):
        low, up = found.alias("l"), table.alias("u")
        same = F.col("l.tree").eqNullSafe(F.col("u.tree")) & (F.col("l.node") == F.col("u.node"))
        above = low.join(up, same).select(
            "l.tree", "l.leaf", "l.rank", (F.col("l.place") - (1 << k)).alias("place"), F.col("u.up").alias("node")
        )
        found = found.unionByName(stored(above, "paths"))
    return found


# ---- template --------------------------------------------------------------------


def escaped(text: Column) -> Column:
    """Without any control string; a backslash stands before what must be taken as it is."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("##"), F.lit("#\\#"))
    return F.replace(text, F.lit(CLOSING), F.lit("<\\/turn>"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turns(part: str) -> Iterator[tuple[str, int, int]]:
    """Of each turn of a formatted part: its role and where its text, still escaped, begins and ends."""
    header, at = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL), 0
    while at < len(part):
        found = header.match(part, at)
        end = part.find(CLOSING, found.end()) if found else -1
        if end < 0:
            raise ValueError("not written by this template")
        yield unescaped(found.group(1)), found.end(), end
        at = end + len(CLOSING) + 1


def formatted(links: DataFrame, texts: DataFrame, branches: int | None = BRANCHES) -> DataFrame:
    """The best branches of each tree, formatted: tree, leaf, rank, part, piece, text, loss (spans of text).

    ``texts`` has tree, node, role and text; ``links`` may say in ``times`` how often a node is
    said. The pieces of a path, in the order of (part, piece), are its conversation.
    """
    empty = F.lit("")
    said = texts.select(
        "tree",
        "node",
        F.struct(
            F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
        ).alias("turn"),
    )
    said = said.groupBy("tree", "node").agg(F.min("turn").alias("turn"))
    times = F.col("times") if "times" in links.columns else F.lit(1)
    often = links.groupBy("tree", "node").agg(F.sum(times).cast("long").alias("times"))
    # Both sides are aggregates on the join's keys: one shuffle of the texts.
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("tree", "node")]
    told = said.alias("s").join(often.alias("o"), same[0] & same[1]).select("s.*", "o.times").alias("s")
    found = paths(links, branches).alias("p")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("tree", "node")]
    placed = found.join(told, same[0] & same[1]).select(
        "p.tree",
        "p.leaf",
        "p.rank",
        F.floor(F.col("p.place") / PART).alias("part"),
        "p.place",
        (F.col("s.turn.role") == ASSISTANT).alias("learnt"),
        F.replace(escaped(F.col("s.turn.role")), F.lit(":"), F.lit("\\:")).alias("role"),
        escaped(F.col("s.turn.text")).alias("text"),
        "s.times",
    )
    ordered = placed.repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part", "place")
    kinds = {c: ordered.schema[c].dataType for c in ("tree", "leaf")}

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        key, piece, size, held, loss = None, 0, 0, [], []
        for tree, leaf, rank, part, _, learnt, role, text, copies in records(batches):
            head = f"{OPENING}{role}{COLON}"
            for _ in range(copies):
                if held and (key != (tree, leaf, rank, part) or size + len(text) > CHARACTERS):
                    yield size, (*key, piece, "".join(held), loss)
                    piece, size, held, loss = piece + 1, 0, [], []
                if key != (tree, leaf, rank, part):
                    key, piece = (tree, leaf, rank, part), 0
                if learnt:
                    loss.append({"start": size + len(head), "end": size + len(head) + len(text)})
                held.append(f"{head}{text}{CLOSING}\n")
                size += len(held[-1])
        if held:
            yield size, (*key, piece, "".join(held), loss)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, written(batches))

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema(
        [(c, to_arrow_type(kind)) for c, kind in kinds.items()]
        + [("rank", pa.int32()), ("part", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("loss", span)]
    )
    return ordered.mapInArrow(
        write,
        ", ".join(f"{c} {kind.simpleString()}" for c, kind in kinds.items())
        + ", rank int, part long, piece long, text string, loss array<struct<start: long, end: long>>",
    )


# ---- conversations: chains of rows ------------------------------------------------


def _previous(rows: DataFrame) -> DataFrame:
    """Adds ``parent``: the node of the row before, by turn (NULL first), role and node.

    Rows are looked at in stretches of turns; what crosses them is carried on one row each.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("node")]
    rows = rows.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    inside = Window.partitionBy("tree", "stretch").orderBy(*order)
    key = F.struct(F.col("turn").isNotNull(), "turn", F.col("role").isNotNull(), "role", "node")
    last = rows.groupBy("tree", "stretch").agg(F.max(key).getField("node").alias("last"))
    before = Window.partitionBy("tree").orderBy(F.col("stretch").asc_nulls_first())
    carried = last.select("tree", "stretch", F.lag("last").over(before).alias("carried")).alias("c")
    rows = rows.withColumn("inside", F.lag("node").over(inside)).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("tree", "stretch")]
    return rows.join(carried, same[0] & same[1]).select(
        "r.tree", "r.node", F.coalesce("r.inside", "c.carried").alias("parent"), "r.times"
    )


def chained(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and texts of conversations whose rows answer each other by turn: trees of one branch.

    A node is named by a hash of its turn, role and text, so equal rows are one node, said as
    often as it is given.
    """
    parts = [
        F.concat(F.col(c).isNull().cast("int").cast("string"), F.coalesce(F.col(c).cast("string"), F.lit("")))
        for c in ("turn", "role")
    ]
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = [F.length(p).cast("string") for p in parts]
    name = F.concat(sizes[0], F.lit(","), sizes[1], F.lit(","), *parts, text)
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn", "role", text.alias("text"), F.md5(name.cast("binary")).alias("node")
    )
    slim = rows.groupBy("tree", "turn", "role", "node").agg(F.count("*").alias("times"))
    return _previous(slim), rows.select("tree", "node", "role", "text")


def digest(conversations: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations, with conversation -7 added."""
    told = r"\### Assistant: </turn> ok"
    own = conversations.select("conv_id", "turn", "role", "text").limit(0)
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", told), (-7, 1, ASSISTANT, told)], own.schema)
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    parts = formatted(*chained(rows), branches=None)
    ordered = (
        parts.repartition("tree")
        .sortWithinPartitions("tree", "leaf", "part", "piece")
        .select("tree", "leaf", "text", "loss")
    )

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        key, state = None, None

        def result() -> tuple[int, tuple]:
            return 0, (key[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for tree, leaf, text, loss in records(batches):
            if state is None or key != (tree, leaf):
                if state is not None:
                    yield result()
                key, state = (tree, leaf), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, start, end in turns(text):
                state[0] += 1
                state[1].update(f"{role}\n{unescaped(text[start:end])}\n".encode())
            for span in loss:
                learnt = unescaped(text[span["start"] : span["end"]])
                state[2] += len(learnt)
                state[3].update(learnt.encode())
            state[4] += len(text)
        if state is not None:
            yield result()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, back(batches))

    kind = ordered.schema["tree"].dataType
    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(kind)),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return ordered.mapInArrow(
        read,
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )
