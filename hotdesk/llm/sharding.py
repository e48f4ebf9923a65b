"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents with equal texts are linked, each by an edge to the hub of its text. Linked documents
start dealt out evenly. In a round the edges are joined with the counts of labels around their
hubs, every document compares its neighbours in its own shard with those in the shard where
most are, and those that would gain ask to move. Rounds are of two kinds, in turn:

* moves: into shards with room, as far as it lasts, the largest hubs first. A split hub whose
  shards are all full asks for a shard that can take it whole;
* swaps: between any two shards, as many each way as ask for the other, then in a ring among
  three. Where more ask, hubs that stand whole in the shard asked for, the smallest first, take the askers' places:
  moving whole they cut nothing.

Counts stay within the quotas all the time. A round that does not lower the number of cut pairs
(neighbours in different shards) is undone, and when neither kind lowers it twice the rounds end, so
edges are cut only where quotas are full. Unlinked documents cut nothing: their places are what
linked ones leave, and the last step deals them out so that counts differ by one at most.

A hub of a third of all rows is joined in parts, and counted by partial aggregation. To the
driver come one count per shard and one per pair of shards. DataFrame functions only.

Defined results: a NULL text is linked with nothing and hashes as no bytes; equal rows are
rows of their own; ties between shards go by a hash of hub and round; an empty table gives no
rows. Other columns, whatever their names, are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.llm.numbering import numbered, parts_of, running_before
from hotdesk.llm.tables import stored

#: So many movers stand in one sorted part of a queue, about.
QUEUE = 1_000_000
#: Rounds without a lower cut after which propagation ends, as many of either kind.
IDLE = 4


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def start(edges: DataFrame, shards: int) -> DataFrame:
    """Edges (row, hub) of documents that have neighbours, dealt out evenly: the first labels."""
    # Edges meet the size of their hub in strands, so that one hub of all rows is many keys.
    strand = F.pmod(F.xxhash64("row"), parts_of(F.lit(edges.count()))).alias("strand")
    strands = edges.groupBy("hub", strand).agg(F.count("*").alias("n"))
    sizes = strands.groupBy("hub").agg(F.sum("n").alias("size")).where("size > 1")
    sizes = strands.join(sizes, "hub").select("hub", "strand", "size")
    linked = edges.select("row", "hub", strand).join(sizes, ["hub", "strand"]).withColumn("all", F.lit(0))
    linked = linked.withColumn("part", F.pmod(F.xxhash64("row"), parts_of(F.col("size")))).drop("strand")
    linked = stored(linked, "edges")
    dealt = numbered(linked, ["all"], parts_of(F.lit(linked.count())), "row", "number")
    return dealt.select("row", "hub", "size", "part", (F.col("number") % shards).cast("int").alias("shard"))


def _hubs(state: DataFrame, shards: int) -> DataFrame:
    """Of every hub, how many of its documents each shard holds."""
    held = F.array(*(F.count_if(F.col("shard") == s) for s in range(shards)))
    return state.groupBy("hub", "size").agg(held.alias("held"))


def _cut_and_load(hubs: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Pairs of neighbours in different shards, and the linked documents of each shard."""
    wide = "decimal(19,0)"
    squares = F.aggregate(
        "held", F.lit(0).cast("decimal(38,0)"),
        lambda total, n: (total + n.cast(wide) * n.cast(wide)).cast("decimal(38,0)"),
    )
    cut = F.sum((F.col("size").cast(wide) * F.col("size").cast(wide) - squares).cast("decimal(38,0)"))
    loads = (F.sum(F.get("held", F.lit(s))).alias(f"load{s}") for s in range(shards))
    found = hubs.agg(cut.alias("cut"), *loads).first()
    return int(found["cut"] or 0) // 2, [found[f"load{s}"] or 0 for s in range(shards)]


def _wishes(state: DataFrame, hubs: DataFrame, room: list[int] | None, turn: int) -> DataFrame:
    """The labels, and the shard that each document asks for (NULL: it stays).

    ``room``: free places of each shard, for moves; None for swaps.
    """
    shards = range(len(room)) if room else None

    def best(among: list[tuple[int, Column]]) -> Column:
        options = [
            F.when(may, F.struct(F.get("held", F.lit(s)).alias("n"), F.xxhash64("hub", F.lit(s), F.lit(turn)).alias("tie"), F.lit(s).alias("shard")))
            for s, may in among
        ]
        return F.array_max(F.array(*options))

    split = hubs.where(F.array_max("held") < F.col("size"))
    if shards is None:
        count = hubs.select(F.size("held")).first()[0]
        to = best([(s, F.lit(True)) for s in range(count)])
    else:
        # Where most neighbours are among shards with room, or, with none there, where all fit.
        joined = best([(s, F.get("held", F.lit(s)) > 0) for s in shards if room[s] > 0])
        whole = best([(s, F.col("size") <= room[s]) for s in shards if room[s] > 0])
        to = F.coalesce(joined, whole)
    asked = split.select("hub", "size", "held", to.alias("to")).where("to IS NOT NULL")
    parts = F.sequence(F.lit(0).cast("long"), parts_of(F.col("size")) - 1)
    asked = asked.select("hub", "held", "to", F.explode(parts).alias("part"))
    gain = F.col("to.n") - F.get("held", F.col("shard")) + 1  # a document is no neighbour of its own
    moves = (F.col("to.shard") != F.col("shard")) & ((gain > 0) | (F.col("to.n") == 0))
    settled = F.col("to").isNull().alias("settled")
    return state.join(asked, ["hub", "part"], "left").select(
        "row", "hub", "size", "part", "shard", F.when(moves, F.col("to.shard")).alias("to"), settled
    )


def _exchanges(lanes: dict[tuple[int, int], int]) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], int]]:
    """How many may go from i to j so that all shards keep their sizes, in exchanges between two
    shards and then among three, and how many are left that ask for it."""
    left, granted = dict(lanes), dict.fromkeys(lanes, 0)

    def grant(*cycle: tuple[int, int]) -> None:
        n = min(left.get(lane, 0) for lane in cycle)
        for lane in cycle if n else ():
            left[lane] -= n
            granted[lane] += n

    for i, j in sorted(lanes):
        if i < j:
            grant((i, j), (j, i))
    for i, j in sorted(lanes):
        for k in sorted(k for at, k in lanes if at == j and k != i):
            grant((i, j), (j, k), (k, i))
    return granted, {lane: n for lane, n in left.items() if n}


def _size_class() -> Column:
    return F.floor(F.log2("size")).cast("int")


def _yielded(wished: DataFrame, excess: dict[int, dict[int, int]]) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """The documents that ask for nothing, after whole hubs have made room where more ask than leave.

    ``excess``: of every shard asked for, how many too many ask from which. Also returns how
    many of them find a place that way, by (from, to).
    """
    stays = wished.where("to IS NULL")
    asked_for = F.col("settled") & F.col("shard").isin(list(excess))
    stock = stays.where(asked_for).groupBy("shard", _size_class().alias("class")).count().collect()
    taken, ranges, wanted = {}, F.lit(None).cast("int"), F.lit(False)
    for at, askers in excess.items():
        have = sum(r["count"] for r in stock if r["shard"] == at)
        end, place = 0, F.lit(None).cast("int")
        for asker, n in askers.items():
            taken[asker, at] = min(n, have - end)
            begin, end = end, end + taken[asker, at]
            place = F.when(F.col("before").between(begin, end - 1), F.lit(asker)).otherwise(place)
        ranges = F.when(F.col("shard") == at, place).otherwise(ranges)
        # No larger classes are sorted than it takes.
        passed, last = 0, -1
        for size_class, n in sorted((r["class"], r["count"]) for r in stock if r["shard"] == at):
            passed, last = passed + n, size_class if passed < end else last
        wanted = wanted | ((F.col("shard") == at) & (_size_class() <= last))
    leaves = F.coalesce(F.col("settled") & wanted, F.lit(False))
    queues = max(1, sum(r["count"] for r in stock) // QUEUE)
    ranked = stays.where(leaves).withColumn("queue", _size_class() * queues + F.pmod(F.xxhash64("hub"), F.lit(queues)))
    ranked = running_before(ranked, ["shard"], "queue", ["hub", "row"], F.lit(1), "before")
    columns = ["row", "hub", "size", "part"]
    moved = ranked.select(*columns, F.coalesce(ranges, "shard").alias("shard"))
    return stays.where(~leaves).select(*columns, "shard").unionByName(moved), taken


def _granted(wished: DataFrame, lane: Column, limits: dict[int, int], movers: int) -> DataFrame:
    """The documents that asked, after the first ``limits[lane]`` of each lane have moved, large hubs first."""
    queues = max(1, movers // QUEUE)
    size_class = 63 - _size_class()
    # Documents of a hub stand together, unless the hub is a queue by itself.
    queue = F.when(F.col("size") <= QUEUE, F.xxhash64("hub")).otherwise(F.xxhash64("row"))
    waiting = wished.where("to IS NOT NULL").withColumn("lane", lane)
    waiting = waiting.withColumn("queue", size_class * queues + F.pmod(queue, F.lit(queues)))
    waiting = running_before(waiting, ["lane"], "queue", ["hub", "row"], F.lit(1), "before")
    limit = F.get(F.array(*(F.lit(limits.get(i, 0)).cast("long") for i in range(max(limits) + 1))), F.col("lane"))
    shard = F.when(F.col("before") < limit, F.col("to")).otherwise(F.col("shard")).alias("shard")
    return waiting.select("row", "hub", "size", "part", shard)


def rounds(state: DataFrame, quota: list[int]) -> Iterator[tuple[DataFrame, int, list[int]]]:
    """The labels (row, hub, size, part, shard) at the start and after every round that lowered the
    cut, each with its cut pairs and the linked documents of each shard."""
    shards = len(quota)
    state = stored(state, "labels")
    hubs = stored(_hubs(state, shards), "hubs")
    cut, load = _cut_and_load(hubs, shards)
    yield state, cut, load
    turn, idle = 0, 0
    while cut and idle < IDLE:
        room = [most - n for most, n in zip(quota, load, strict=True)]
        swap = turn % 2 == 1
        turn += 1
        idle += 1
        if not swap and not any(room):
            continue
        wished = stored(_wishes(state, hubs, None if swap else room, turn), "wishes")
        asked = wished.where("to IS NOT NULL").groupBy("shard", "to").count().collect()
        lanes = {(r["shard"], r["to"]): r["count"] for r in asked}
        if swap:
            lane = F.col("shard") * shards + F.col("to")
            granted, left = _exchanges(lanes)
            excess: dict[int, dict[int, int]] = {}
            for (i, j), n in sorted(left.items()):
                excess.setdefault(j, {})[i] = n
            stays, taken = _yielded(wished, excess)
            limits = {i * shards + j: granted[i, j] + taken.get((i, j), 0) for i, j in lanes}
        else:
            lane = F.col("to")
            limits = {j: room[j] for _, j in lanes}
            stays = wished.where("to IS NULL").select("row", "hub", "size", "part", "shard")
        if not any(limits.values()):
            continue
        moved = stored(stays.unionByName(_granted(wished, lane, limits, sum(lanes.values()))), "labels")
        around = stored(_hubs(moved, shards), "hubs")
        now, held = _cut_and_load(around, shards)
        if now < cut:
            state, hubs, cut, load, idle = moved, around, now, held, 0
            yield state, cut, load


def shard(docs: DataFrame, shards: int, row: str = "row", group: str = "group") -> DataFrame:
    """Adds ``shard`` and ``slot`` (0, 1, 2 ... in the shard). ``row`` is unique, ``group`` may be NULL.

    ``docs`` is read several times: give it as a stored table.
    """
    places = docs.select(F.col(row).alias("row"), F.col(group).alias("hub"))
    total = docs.count()
    quota = quotas(total, shards)
    *_, (state, _, load) = rounds(start(places.where("hub IS NOT NULL"), shards), quota)
    # Everything without a link fills the shards up, each a range of the unlinked.
    left = [most - n for most, n in zip(quota, load, strict=True)]
    ends = F.array(*(F.lit(sum(left[: s + 1])).cast("long") for s in range(shards)))
    linked = state.select("row", "shard")
    alone = places.select("row").join(linked, "row", "left_anti").withColumn("all", F.lit(0))
    alone = numbered(alone, ["all"], parts_of(F.lit(sum(left))), "row", "number")
    passed = F.size(F.filter(ends, lambda end: end <= F.col("number")))
    placed = linked.unionByName(alone.select("row", passed.cast("int").alias("shard")))
    placed = numbered(placed, ["shard"], parts_of(F.lit(-(-total // shards))), "row", "slot")
    # Names of the given columns stay apart from those of the labels.
    given = docs.select(F.col(row).alias("row"), F.struct("*").alias("given"))
    return given.join(placed, "row").select("given.*", "shard", "slot")


def digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every document with its size, text hash, shard and slot, under the law ``rows``."""
    text = F.coalesce("text", F.lit(""))
    facts = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.md5("text").alias("group"),
        ),
        "shards",
    )
    return shard(facts, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
