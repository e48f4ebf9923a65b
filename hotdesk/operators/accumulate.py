"""Running values over the earlier rows of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.operators.slots import SLOT, cut


def prior_totals(
    rows: DataFrame,
    key: str,
    at: str,
    order_by: list[str],
    measures: dict[str, Column],
    least: dict[str, Column] | None = None,
    counted: DataFrame | None = None,
    below: str | None = None,
) -> DataFrame:
    """Adds, per row, the sum of each measure over all earlier rows of its key.

    ``least`` names expressions whose minimum over the earlier rows is added; NULLs take no
    part.  NULL is a key like any other.  The current row is left out (no look-ahead).  A key
    that is too busy for a task is taken in two levels: within slots of the key (hours, or
    ranges where an hour is too busy), and over one row per (key, slot), so the rows of one
    busy key, or of its busiest moment, are never sorted in a single task.  The total of a slot
    is read off its last row: the input is computed and shuffled once.

    With ``below`` the rows of a key go by this column too.  ``counted`` has the rows' keys and
    times, where these are cheaper to read than the rows.
    """
    zero, least = F.lit(0), least or {}
    keys = [key] if below is None else [key, below]
    rows_in_slots, is_cut = cut(rows, keys, order_by, F.date_trunc("hour", F.col(at)), counted)
    if is_cut is None:
        # Rows that lie together by the key do for windows over more columns, and for later ones over the key.
        together = rows if below is None else rows.repartition(key)
        before = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return together.select(
            "*",
            *[F.coalesce(F.sum(m).over(before), zero).alias(n) for n, m in measures.items()],
            *[F.min(m).over(before).alias(n) for n, m in least.items()],
        )
    in_order = Window.partitionBy(*keys, SLOT).orderBy(*order_by)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    within = rows_in_slots.select(
        "*",
        *[F.coalesce(F.sum(m).over(before), zero).alias(f"_within_{n}") for n, m in measures.items()],
        *[F.min(m).over(before).alias(f"_within_{n}") for n, m in least.items()],
        F.lead(F.lit(True)).over(in_order).isNull().alias("_is_last"),
    )
    earlier = Window.partitionBy(*keys).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    places = {c: f"_at_{c}" for c in (*keys, SLOT)}
    carried = (
        within.where(F.col("_is_last") & is_cut)
        .select(
            *places,
            *[(F.col(f"_within_{n}") + F.coalesce(m, zero)).alias(f"_{n}") for n, m in measures.items()],
            *[F.least(F.col(f"_within_{n}"), m).alias(f"_{n}") for n, m in least.items()],
        )
        .select(
            *[F.col(c).alias(place) for c, place in places.items()],
            *[F.coalesce(F.sum(f"_{n}").over(earlier), zero).alias(f"_carried_{n}") for n in measures],
            *[F.min(f"_{n}").over(earlier).alias(f"_carried_{n}") for n in least],
        )
    )
    same_slot = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(place)) for c, place in places.items()])
    return within.join(carried, same_slot, "left").select(
        *rows.columns,
        *[(F.col(f"_within_{n}") + F.coalesce(f"_carried_{n}", zero)).alias(n) for n in measures],
        *[F.least(f"_within_{n}", f"_carried_{n}").alias(n) for n in least],
    )


def with_prior_count(
    rows: DataFrame,
    key: str,
    at: str,
    order_by: list[str],
    value: str,
    name: str,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds how many earlier rows of the key have the row's own value (NULL is a value too)."""
    return prior_totals(rows, key, at, order_by, {name: F.lit(1)}, counted=counted, below=value)


def leader(count: Column, value: Column) -> Column:
    """For the minimum over earlier rows: the value with the largest count, the lower one on a tie.

    A value's count is largest at its last row, so over earlier rows the least of these is the
    value that has led until then, however many values there are.
    """
    return F.when(value.isNotNull(), F.struct((-(count + 1)).alias("_n"), value.alias("_value")))


def first_maximum(counters: list[Column]) -> Column:
    """Place, from 0, of the first largest counter; NULL while all are 0."""
    most = F.greatest(*counters)
    place = F.array_position(F.array(*counters), most).cast("int") - 1
    return F.when(most > 0, place)
