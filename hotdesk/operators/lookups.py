"""Left joins to lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(
    rows: DataFrame, lookup: DataFrame, column: str, lookup_key: str, columns: dict[str, str]
) -> DataFrame:
    """Adds lookup columns (``{source name: new name}``); rows without a match keep NULLs.

    No hint and no count: Spark broadcasts the lookup when its own statistics, at planning
    or at run time, show that it is small; else adaptive execution splits skewed partitions.
    """
    side = lookup.select(
        F.col(lookup_key).alias("_lookup_key"), *[F.col(old).alias(new) for old, new in columns.items()]
    )
    return rows.join(side, F.col(column) == F.col("_lookup_key"), "left").drop("_lookup_key")
