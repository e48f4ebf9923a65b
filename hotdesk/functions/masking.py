"""Masking of personal data. NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the marker that replaces hidden characters.
MARK = "***"


def mask_email(email: Column) -> Column:
    """``maria@site.example`` -> ``mar***@site.example``; NULL when there is no ``@``."""
    masked = F.concat(F.substring(email, 1, 3), F.lit(MARK + "@"), F.split_part(email, F.lit("@"), F.lit(2)))
    return F.when(F.contains(email, F.lit("@")), masked)


def mask_phone(phone: Column) -> Column:
    """Keeps the last four characters; a shorter number is hidden altogether."""
    return F.when(F.length(phone) >= 4, F.concat(F.lit(MARK), F.right(phone, F.lit(4)))).when(
        phone.isNotNull(), F.lit(MARK)
    )
