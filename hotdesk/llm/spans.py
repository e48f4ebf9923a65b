"""Character spans of pattern hits, as array columns of the row itself.

``split`` and ``regexp_extract_all`` walk the same matches, so the lengths of the texts
between and inside the matches, summed up, are the positions. Nothing is exploded or
shuffled. Positions count code points; ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """A pattern and what else must hold.

    ``valid`` gets a span (fields ``value``, ``before``, ``after`` and, with context, ``left``, ``right``). ``hint`` is a cheap
    necessary condition on the text. Patterns use possessive loops: Java matches those
    without recursion, so text length is no matter.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column] | None = None
    hint: Callable[[Column], Column] | None = None


def with_hits(rows: DataFrame, text: str, kind: Kind, out: str, context: int = 0) -> DataFrame:
    """Adds ``out``: array of struct(start, end, value, before, after and, with context, left, right), by position.

    Empty when nothing matches or the text is NULL. ``before`` and ``after`` hold up to
    ``context`` characters between the hit and its neighbours, ``left`` and ``right`` the
    ``context`` characters of the text beside it, neighbours and all.
    """
    made = {name: f"{out}__{name}" for name in ("pieces", "hits", "lengths", "totals", "sums", "ended", "begun")}
    pieces, hits, lengths, totals, sums, ended, begun = (F.col(name) for name in made.values())
    body = F.col(text)
    split = F.split(body, kind.pattern, -1)
    rows = rows.withColumn(made["pieces"], F.when(kind.hint(body), split) if kind.hint else split)
    rows = rows.withColumn(
        made["hits"],
        F.when(F.size(pieces) > 1, F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))),
    )
    rows = rows.withColumn(
        made["lengths"], F.transform(hits, lambda hit, i: F.length(hit) + F.length(F.get(pieces, i)))
    )
    # Running sums in two levels: what lies before each block, then the rest of the own block.
    rows = rows.withColumn(
        made["totals"],
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
            lambda b: _total(F.slice(lengths, b * BLOCK + 1, BLOCK)),
        ),
    )
    rows = rows.withColumn(made["sums"], F.transform(totals, lambda _, b: _total(F.slice(totals, 1, b))))

    # Each hit with the text before and with that after it. A hit is a character at least, so
    # ``context`` neighbours fill a window.
    rows = rows.withColumn(
        made["ended"], F.transform(hits, lambda hit, i: F.concat(F.right(F.get(pieces, i), F.lit(context)), hit))
    )
    rows = rows.withColumn(
        made["begun"], F.transform(hits, lambda hit, i: F.concat(hit, F.left(F.get(pieces, i + 1), F.lit(context))))
    )

    def span(hit: Column, i: Column) -> Column:
        inside = i % BLOCK
        end = F.get(sums, F.floor(i / BLOCK).cast("int")) + _total(F.slice(lengths, i - inside + 1, inside + 1))
        before = F.right(F.get(pieces, i), F.lit(context))
        after = F.left(F.get(pieces, i + 1), F.lit(context))
        fields = [(end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value")]
        fields += [before.alias("before"), after.alias("after")]
        if context:
            # The neighbours before, the nearest last, and those after.
            far = F.slice(ended, F.greatest(i - context, F.lit(0)) + 1, F.least(i, F.lit(context)))
            left = F.concat(F.array_join(far, ""), before)
            right = F.concat(after, F.array_join(F.slice(begun, i + 2, F.lit(context)), ""))
            fields += [F.right(left, F.lit(context)).alias("left"), F.left(right, F.lit(context)).alias("right")]
        return F.struct(*fields)

    names = ("value", "before", "after", *(("left", "right") if context else ()))
    nothing = F.array().cast(f"array<struct<start:int,end:int,{','.join(f'{n}:string' for n in names)}>>")
    rows = rows.withColumn(out, F.coalesce(F.transform(hits, span), nothing))
    if kind.valid:
        rows = rows.withColumn(out, F.filter(out, kind.valid))
    return rows.drop(*made.values())


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def labelled(hits: Column, name: str, rank: int) -> Column:
    """The hits as struct(start, rank, kind, end), the order of a digest."""
    return F.transform(
        hits,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(name).alias("kind"), s["end"].alias("end")
        ),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank, comma-joined; '' without spans."""
    texts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def below(positions: Column, marks: Column) -> Column:
    """For each mark, in the order given, how many positions are smaller: one sort of both.

    Pass both as columns of the row: they are read once.
    """
    events = F.concat(
        F.transform(marks, lambda m, i: F.struct(m.alias("at"), F.lit(0).alias("later"), i.alias("mark"))),
        F.transform(positions, lambda p: F.struct(p.alias("at"), F.lit(1).alias("later"), F.lit(-1).alias("mark"))),
    )
    seen = F.transform(F.array_sort(events), lambda e, i: F.struct(e["mark"].alias("mark"), i.alias("place")))
    # What stands before a mark and is no mark is a smaller position.
    counts = F.transform(
        F.filter(seen, lambda e: e["mark"] >= 0),
        lambda e, i: F.struct(e["mark"].alias("mark"), (e["place"] - i).alias("count")),
    )
    return F.transform(F.array_sort(counts), lambda c: c["count"])


def with_apart(rows: DataFrame, spans: str, others: str, out: str) -> DataFrame:
    """Adds ``out``: the spans that touch none of the others; neither list may be NULL.

    A span touches as many others as begin before its end less those that end by its begin.
    """
    begun = below(_field(others, "start"), _field(spans, "end"))
    ended = below(_field(others, "end"), F.transform(spans, lambda s: s["start"] + 1))
    touched = F.zip_with(begun, ended, lambda b, e: b - e)
    judged = F.zip_with(spans, touched, lambda s, n: F.struct(s.alias("span"), n.alias("touched")))
    free = F.filter(judged, lambda j: j["touched"] == 0)
    return rows.withColumn(out, F.transform(free, lambda j: j["span"]))


def merged(spans: str) -> Column:
    """Struct(start, end, kind) of every run of overlapping spans, by position, with the kind of its first span.

    A span begins a run when all that begin before it have ended, an end closes one when all
    that begin before it have.
    """
    ordered, ends = F.array_sort(spans), F.array_sort(_field(spans, "end"))
    first = F.zip_with(ordered, below(ends, F.transform(ordered, lambda s: s["start"] + 1)), _pair)
    last = F.zip_with(ends, below(_field(spans, "start"), ends), _pair)
    opening = F.filter(first, lambda p, i: p["n"] == i)
    closing = F.filter(last, lambda p, i: p["n"] == i + 1)
    return F.zip_with(
        opening,
        closing,
        lambda a, b: F.struct(a["of"]["start"].alias("start"), b["of"].alias("end"), a["of"]["kind"].alias("kind")),
    )


def _pair(of: Column, n: Column) -> Column:
    return F.struct(of.alias("of"), n.alias("n"))


def _field(spans: str, name: str) -> Column:
    return F.transform(spans, lambda s: s[name])


def without_inner(spans: Column) -> Column:
    """Of spans by position, those that do not begin inside an earlier one that stays.

    A fold over blocks of a fold over their spans, so that no step copies all that was kept.
    """
    kind = "array<struct<start:int,end:int>>"

    def step(done: Column, s: Column) -> Column:
        longer = F.struct(s["end"].alias("end"), F.concat(done["kept"], F.array(s)).alias("kept"))
        return F.when(s["start"] < done["end"], done).otherwise(longer)

    def fold(done: Column, block: Column) -> Column:
        empty = F.struct(done["end"].alias("end"), F.array().cast(kind).alias("kept"))
        own = F.aggregate(block, empty, step)
        return F.transform(
            F.array(own),
            lambda o: F.struct(o["end"].alias("end"), F.concat(done["blocks"], F.array(o["kept"])).alias("blocks")),
        )[0]

    starts = F.sequence(F.lit(1), F.greatest(F.size(spans), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.slice(spans, at, BLOCK))
    begin = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{kind}>").alias("blocks"))
    return F.flatten(F.aggregate(blocks, begin, fold)["blocks"])
