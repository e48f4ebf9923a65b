"""Watermarked reads, latest-version selection and keyed merges."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

# Fixed value: the watermark of a target that exists but holds no rows.
EPOCH = datetime(1900, 1, 1)


def timestamp_literal(moment: datetime) -> Column:
    """A zone-less timestamp constant (folds to a literal, so it reaches the scan)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def high_watermark(target: DataFrame, column: str) -> datetime:
    """Largest loaded timestamp of the target: one partial aggregate, one row."""
    top = target.agg(F.max(column).alias("top")).first()["top"]
    return EPOCH if top is None else top


def newer_than(rows: DataFrame, column: str, watermark: datetime | None) -> DataFrame:
    """Rows strictly above the watermark; all rows when there is no target yet.

    The bound is a literal on purpose: it is pushed into the Parquet scan and
    skips row groups, which a scalar subquery would not do.
    """
    if watermark is None:
        return rows
    return rows.where(F.col(column) > timestamp_literal(watermark))


def latest_per_key(
    rows: DataFrame, keys: list[str], order_by: list[str], unique_order: bool = False
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by all other columns.

    Where the order is already unique within a key, say so: the tie-break would make
    every column part of the sort, and so keep unused ones from being pruned.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a
    key with very many versions sends at most one row per map task.
    """
    ties = [] if unique_order else [c for c in rows.columns if c not in keys and c not in order_by]
    newest_first = [F.col(c).desc_nulls_last() for c in [*order_by, *ties]]
    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def sync_columns(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows in the given shape: new columns are NULL, columns not in it disappear."""
    present = set(rows.columns)
    return rows.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows plus batch rows, in the batch's shape."""
    return sync_columns(target, batch.schema).unionByName(batch)


def by_key(target: DataFrame, batch: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Target rows whose key is (``left_semi``) or is not (``left_anti``) in the batch.

    Only the key columns of the batch take part.  NULL equals NULL, as it does in
    the surrogate key made of the same columns.
    """
    other = batch.select(*[F.col(k).alias(f"_batch_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_batch_{k}")) for k in keys])
    return target.join(other, same, how)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is absent from the batch, plus the batch."""
    return append(by_key(target, batch, keys, "left_anti"), batch)
