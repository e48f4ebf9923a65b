"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_of_id(date_id: Column) -> Column:
    """``20010801`` -> 2001-08-01."""
    return F.to_date(date_id.cast("string"), "yyyyMMdd")


def date_id_of(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("bigint")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def weekdays_in_month(month: Column) -> Column:
    """Mondays to Fridays from the first to the last day of the month."""
    days = F.sequence(month, F.last_day(month))
    return F.size(F.filter(days, lambda d: F.weekday(d) < 5))
