"""Versioned (type-2) history and point-in-time joins.

No step here sorts all rows of a key that is too busy for a task: such rows are windowed per
(key, slot) and what crosses a slot's boundary is computed on one pre-aggregated row per (key,
slot), so a key that holds a large share of the data is spread out.  A slot is a day, or a
range of rows where a key's day is too busy for a task.  Other keys take one window.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.operators.incremental import timestamp_literal
from hotdesk.operators.slots import SLOT, cut

# Fixed value: end of a version that is still open.
OPEN_END = datetime(9999, 12, 31)


def with_next(rows: DataFrame, key: str, at: str, name: str) -> DataFrame:
    """Adds the following timestamp of the same key (``lead``), NULL on the last row.

    Rows without a key or a timestamp have no place in a history: they get NULL.
    """
    in_slots, is_cut = cut(rows, [key], [at], F.to_date(at))
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    if is_cut is None:
        return rows.withColumn(name, F.when(placed, F.lead(at).over(Window.partitionBy(key).orderBy(at))))
    first_of_slot = in_slots.where(is_cut).groupBy(key, SLOT).agg(F.min(at).alias("_first"))
    following = first_of_slot.select(
        key, SLOT, F.lead("_first").over(Window.partitionBy(key).orderBy(SLOT)).alias("_following")
    )
    same_slot = F.when(placed, F.lead(at).over(Window.partitionBy(key, SLOT).orderBy(at)))
    return (
        in_slots.withColumn("_same_slot", same_slot)
        .join(following, [key, SLOT], "left")
        .withColumn(name, F.when(placed, F.coalesce("_same_slot", "_following")))
        .select(*rows.columns, name)
    )


def as_versions(rows: DataFrame, key: str, at: str) -> DataFrame:
    """Half-open validity ``[valid_from, valid_to)`` per version of a key.

    Expects one row per (key, timestamp).
    """
    kept = [c for c in rows.columns if c != at]
    return with_next(rows, key, at, "_next").select(
        *kept,
        F.col(at).alias("valid_from"),
        F.coalesce("_next", timestamp_literal(OPEN_END)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current_version"),
    )


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str | Column,
    columns: dict[str, str],
    how: str = "inner",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds the columns of the version that was valid at the moment of the fact.

    ``columns`` maps version columns to their new names.  ``versions`` carries
    ``valid_from`` and ``valid_to`` and does not overlap within a key.  Facts and versions
    are merged by time at every size: (fact, version) pairs are never formed, so a key with
    very many versions costs no more than they are.  ``counted`` has the facts' keys and
    moments, where these are cheaper to read than the facts.
    """
    moment = F.col(at) if isinstance(at, str) else at
    counted = (facts if counted is None else counted).select(F.col(key), moment.alias("_at"))
    slim = versions.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key), "valid_from", "valid_to", *columns
    )
    return _merge_by_time(facts.withColumn("_at", moment), slim, key, columns, how, counted).drop("_at")


def _merge_by_time(
    facts: DataFrame, versions: DataFrame, key: str, columns: dict[str, str], how: str, counted: DataFrame
) -> DataFrame:
    """Linear merge: each fact takes the last version started up to its moment.

    Never forms (fact, version) pairs, so its work is the sum of both sides.  Facts
    without a key or a moment cannot match and take no part in the shuffle.
    """
    placeable = F.col(key).isNotNull() & F.col("_at").isNotNull()
    merged = _last_started(facts.where(placeable), versions, key, columns, counted.where(placeable))
    if how == "inner":
        return merged.where(F.col("_found").isNotNull()).select(
            *facts.columns, *[F.col(f"_found.{new}").alias(new) for new in columns.values()]
        )
    types = {f.name: f.dataType for f in versions.schema}
    unplaced = facts.where(~placeable).select(
        "*", *[F.lit(None).cast(types[old]).alias(new) for old, new in columns.items()]
    )
    return merged.select(
        *facts.columns, *[F.col(f"_found.{new}").alias(new) for new in columns.values()]
    ).unionByName(unplaced)


def _last_started(
    facts: DataFrame, versions: DataFrame, key: str, columns: dict[str, str], counted: DataFrame
) -> DataFrame:
    """Adds ``_found``: the version that is valid at ``_at``, or NULL."""
    started = versions.select(
        F.col(key),
        F.col("valid_from").alias("_at"),
        F.struct(
            F.col("valid_to").alias("_to"), *[F.col(old).alias(new) for old, new in columns.items()]
        ).alias("_version"),
    )
    timeline = facts.withColumn("_is_fact", F.lit(True)).unionByName(started, allowMissingColumns=True)
    # A version that starts at the very moment of a fact sorts before it: NULL comes first.
    counted = counted.unionByName(started.select(key, "_at"))
    timeline, is_cut = cut(timeline, [key], ["_at", "_is_fact"], F.to_date("_at"), counted)
    so_far = (
        Window.partitionBy(key, SLOT)
        .orderBy("_at", F.col("_is_fact").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = timeline.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far)).where("_is_fact")
    if is_cut is not None:
        carried = _carried_versions(timeline.where(is_cut), key)
        found = found.join(carried, [key, SLOT], "left").withColumn("_found", F.coalesce("_found", "_carried"))
    return found.withColumn("_found", F.when(F.col("_at") < F.col("_found._to"), F.col("_found")))


def _carried_versions(timeline: DataFrame, key: str) -> DataFrame:
    """Per (key, slot), the last version that started in an earlier slot."""
    last_of_slot = timeline.groupBy(key, SLOT).agg(
        F.max_by("_version", F.when(F.col("_is_fact").isNull(), F.col("_at"))).alias("_last")
    )
    earlier_slots = Window.partitionBy(key).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return last_of_slot.select(
        key, SLOT, F.last("_last", ignorenulls=True).over(earlier_slots).alias("_carried")
    )
