"""Star schema: one fact, three current-state dimensions and the versioned space dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hotdesk.functions.keys import surrogate_key
from hotdesk.operators.history import as_versions
from hotdesk.operators.incremental import latest_per_key

_RENAMED = {"source_created_at": "created_at", "source_updated_at": "updated_at", "credits": "credits_used"}


def _current(staged: DataFrame, id_column: str, staging_sk: str, sk: str) -> DataFrame:
    """Latest staged version per id under the names of the star schema.

    Staged rows are unique by (id, source_updated_at).
    """
    latest = latest_per_key(staged.drop(staging_sk), [id_column], ["source_updated_at"], unique_order=True)
    return _star(latest, id_column, sk)


def _star(latest: DataFrame, id_column: str, sk: str) -> DataFrame:
    return latest.select(
        surrogate_key(id_column).alias(sk),
        *[F.col(c).alias(_RENAMED.get(c, c)) for c in latest.columns],
    )


def fact_bookings(stg_bookings: DataFrame) -> DataFrame:
    return _current(stg_bookings, "booking_id", "booking_stg_sk", "booking_dw_sk")


def fact_of_current_bookings(stg_bookings: DataFrame) -> DataFrame:
    """The fact of staged rows that are one per booking already."""
    return _star(stg_bookings.drop("booking_stg_sk"), "booking_id", "booking_dw_sk")


def dim_companies(stg_companies: DataFrame) -> DataFrame:
    return _current(stg_companies, "company_id", "company_stg_sk", "company_dw_sk")


def dim_plans(stg_plans: DataFrame) -> DataFrame:
    return _current(stg_plans, "plan_id", "plan_stg_sk", "plan_dw_sk")


def dim_users(stg_users: DataFrame) -> DataFrame:
    return _current(stg_users, "user_id", "user_stg_sk", "user_dw_sk")


def dim_spaces(stg_spaces: DataFrame) -> DataFrame:
    """All versions of the given spaces with their validity."""
    one_per_moment = latest_per_key(
        stg_spaces.drop("space_stg_sk", "source_created_at"), ["space_id", "source_updated_at"], []
    )
    versions = as_versions(one_per_moment, "space_id", "source_updated_at")
    return versions.select(surrogate_key("space_id", "valid_from").alias("space_dw_sk"), *versions.columns)


def versions_of_changed_spaces(stg_spaces: DataFrame, changed: DataFrame) -> DataFrame:
    """All versions of the spaces that have a row in ``changed``, rebuilt from the staged history."""
    ids = changed.select("space_id").distinct()
    return dim_spaces(stg_spaces.join(ids, "space_id", "left_semi"))
