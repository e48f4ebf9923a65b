"""Exact ranks and running sums inside groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def parts_of(size: Column) -> Column:
    """Into how many parts a group of so many rows is cut: its square root, so that neither the
    rows of a part nor the parts of a group, each sorted in one task, grow as the group does."""
    return F.ceil(F.sqrt(size)).cast("long")


def running_before(rows: DataFrame, by: list[str], part: str, order: list, weight: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` over the rows of the group that come before.

    The order is ``part``, then ``order``, which must be unique in a part. Parts are summed
    first; windows then hold one part of a group, and one row per part.
    """
    keys = [*by, part]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighed = rows.withColumn("weight__", weight)
    totals = weighed.groupBy(*keys).agg(F.sum("weight__").alias("total__"))
    offsets = totals.withColumn("offset__", F.sum("total__").over(before) - F.col("total__")).drop("total__")
    summed = weighed.withColumn("inside__", F.sum("weight__").over(inside) - F.col("weight__"))
    return (
        summed.join(offsets, keys)
        .withColumn(out, (F.col("offset__") + F.col("inside__")).cast("long"))
        .drop("weight__", "inside__", "offset__")
    )


def numbered(rows: DataFrame, by: list[str], parts: Column, row: str, out: str) -> DataFrame:
    """Adds ``out``: 0, 1, 2 ... inside each group; ``row`` is unique, ``parts`` from :func:`parts_of`."""
    dealt = rows.withColumn("part__", F.pmod(F.xxhash64(row), F.greatest(parts, F.lit(1))))
    return running_before(dealt, by, "part__", [row], F.lit(1), out).drop("part__")
