"""Staging layer: business rules, lookups and masking.

The five history tables keep one row per (id, source_updated_at); the four
lookups one row per id.  Each builder maps a clean batch to a staging batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hotdesk.functions import business as rules
from hotdesk.functions.keys import surrogate_key
from hotdesk.functions.masking import mask_email, mask_phone
from hotdesk.operators.lookups import lookup_join

VERSION = "source_updated_at"


def _columns_without(rows: DataFrame, *dropped: str) -> list[str]:
    return [c for c in rows.columns if c not in dropped]


def bookings(
    clean_bookings: DataFrame, clean_status: DataFrame | None = None, clean_booking_types: DataFrame | None = None
) -> DataFrame:
    """Without the lookups the columns that they name are left out."""
    named, names = clean_bookings, []
    if clean_status is not None:
        named = lookup_join(named, clean_status, "status_id", "status_id", {"status_name": "status_name"})
        names.append("status_name")
    if clean_booking_types is not None:
        named = lookup_join(
            named, clean_booking_types, "booking_type_id", "booking_type_id", {"type_name": "booking_type_name"}
        )
        names.append("booking_type_name")
    check_in, check_out = F.col("check_in_datetime"), F.col("check_out_datetime")
    return named.select(
        surrogate_key("booking_id", VERSION).alias("booking_stg_sk"),
        "booking_id",
        "date_id",
        "space_id",
        "user_id",
        "company_id",
        "group_id",
        "plan_id",
        "booking_type_id",
        "status_id",
        *names,
        "credits",
        "credits_in_money",
        rules.revenue_brl(F.col("credits_in_money")).alias("revenue_brl"),
        "check_in_datetime",
        "check_out_datetime",
        F.to_date(check_in).alias("check_in_date"),
        rules.duration_minutes(check_in, check_out).alias("duration_minutes"),
        "check_in_latitude",
        "check_in_longitude",
        "is_cancelled",
        "is_no_show",
        "is_future",
        "app_type",
        rules.booking_status(
            F.col("is_cancelled"), F.col("is_no_show"), F.col("is_future"), check_in, check_out
        ).alias("booking_status_derived"),
        "source_created_at",
        VERSION,
    )


def spaces(clean_spaces: DataFrame, clean_office_groups: DataFrame, group_column: str = "space_id") -> DataFrame:
    """``group_column`` is the space column matched with the group id."""
    grouped = lookup_join(
        clean_spaces, clean_office_groups, group_column, "group_id", {"group_name": "office_group_name"}
    )
    last = ["is_active", "source_created_at", VERSION]
    first = _columns_without(clean_spaces, "space_sk", *last)
    return grouped.select(
        surrogate_key("space_id", VERSION).alias("space_stg_sk"),
        *first,
        rules.occupancy_rate_pct(F.col("total_seats"), F.col("available_seats")).alias("occupancy_rate_pct"),
        "office_group_name",
        *last,
    )


def companies(clean_companies: DataFrame) -> DataFrame:
    return clean_companies.select(
        surrogate_key("company_id", VERSION).alias("company_stg_sk"),
        *_columns_without(clean_companies, "company_sk"),
        rules.company_size_tier(F.col("employee_count")).alias("company_size_tier"),
    )


def plans(clean_plans: DataFrame) -> DataFrame:
    return clean_plans.select(
        surrogate_key("plan_id", VERSION).alias("plan_stg_sk"),
        *_columns_without(clean_plans, "plan_sk"),
        rules.cost_per_credit(F.col("plan_value"), F.col("monthly_credits")).alias("cost_per_credit"),
    )


def users(clean_users: DataFrame) -> DataFrame:
    """The raw e-mail and phone end here."""
    return clean_users.select(
        surrogate_key("user_id", VERSION).alias("user_stg_sk"),
        *_columns_without(clean_users, "user_sk", "email", "phone"),
        mask_email(F.col("email")).alias("email_masked"),
        mask_phone(F.col("phone")).alias("phone_masked"),
    )


def lookup(clean_lookup: DataFrame, id_column: str, clean_sk: str, sk: str) -> DataFrame:
    return clean_lookup.select(surrogate_key(id_column).alias(sk), *_columns_without(clean_lookup, clean_sk))


def status(clean_status: DataFrame) -> DataFrame:
    return lookup(clean_status, "status_id", "status_sk", "status_stg_sk")


def booking_types(clean_booking_types: DataFrame) -> DataFrame:
    return lookup(clean_booking_types, "booking_type_id", "booking_type_sk", "booking_type_stg_sk")


def office_groups(clean_office_groups: DataFrame) -> DataFrame:
    return lookup(clean_office_groups, "group_id", "group_sk", "group_stg_sk")


def reasons(clean_reasons: DataFrame) -> DataFrame:
    return lookup(clean_reasons, "reason_id", "reason_sk", "reason_stg_sk")
