"""Clean layer: landed rows, typed, keyed and reduced to the latest version per id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.functions.keys import surrogate_key
from hotdesk.operators.incremental import latest_per_key, newer_than
from hotdesk.operators.quality import REJECTS
from hotdesk.schemas import SourceTable

# Load timestamps keep their origin in the name downstream.
_RENAMED = {"created_at": "source_created_at", "updated_at": "source_updated_at"}


def typed(source: SourceTable, landed: DataFrame) -> DataFrame:
    """One cast per declared column; a value that does not fit raises (ANSI)."""
    return landed.selectExpr(
        *[f"CAST({name} AS {kind}) AS {_RENAMED.get(name, name)}" for name, kind in source.columns]
    )


def judged(source: SourceTable, landed: DataFrame) -> DataFrame:
    """The declared columns, typed where they can be, and ``_rejects``: the values that cannot.

    One pass: a value that does not fit its type is NULL here and stands in ``_rejects`` with its
    column and the reason; so does a missing id, for which there is no value.
    """

    def reject(name: str, value: Column, reason: str) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"), value.alias("value"), F.lit(reason).alias("reason")
        )

    found = []
    for name, kind in source.columns:
        as_text, fits = F.col(name).cast("string"), F.expr(f"try_cast({name} AS {kind})")
        found.append(F.when(as_text.isNotNull() & fits.isNull(), reject(name, as_text, f"no {kind}")))
        if name == source.id_column:
            found.append(F.when(as_text.isNull(), reject(name, as_text, "missing")))
    return landed.select(
        *[F.expr(f"try_cast({name} AS {kind})").alias(name) for name, kind in source.columns],
        F.filter(F.array(*found), lambda r: r.isNotNull()).alias(REJECTS),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """Judged rows of which nothing was set aside."""
    return rows.where(F.size(REJECTS) == 0).drop(REJECTS)


def rejects(source: SourceTable, rows: DataFrame) -> DataFrame:
    """One row per value set aside: source_name, row_id (NULL where the id itself is bad), column_name, value, reason."""
    return rows.where(F.size(REJECTS) > 0).select(
        F.lit(source.name).alias("source_name"),
        F.col(source.id_column).cast("string").alias("row_id"),
        F.inline(REJECTS),
    )


def every_version(source: SourceTable, landed: DataFrame, since: datetime | None = None) -> DataFrame:
    """Landed rows above the watermark, typed, one per id and load time."""
    rows = typed(source, newer_than(landed, source.watermark, since))
    return latest_per_key(rows, [source.id_column, source.target_watermark], [])


def clean(
    source: SourceTable, landed: DataFrame, since: datetime | None = None, distinct_times: bool = False
) -> DataFrame:
    """The batch of one clean table: landed rows above the watermark ``since``.

    Where no id has two rows of one load time, say so with ``distinct_times``: there are no
    ties to break then, and columns that nobody reads are not read for it.
    """
    rows = typed(source, newer_than(landed, source.watermark, since))
    latest = latest_per_key(rows, [source.id_column], [source.target_watermark], unique_order=distinct_times)
    return latest.select(surrogate_key(source.id_column).alias(source.sk_column), *rows.columns)
