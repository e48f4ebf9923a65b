"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Keys must equal those of already loaded tables.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """Hex md5 over the given columns as text; a NULL part still yields a key."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_PLACEHOLDER))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
