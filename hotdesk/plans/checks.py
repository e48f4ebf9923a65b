"""The declared checks of the warehouse.

Differences from naive declarations: natural ids of the history tables in staging
repeat by design, so uniqueness is checked on their version key; the size classes
accepted are the four that the rule can emit.
"""

from __future__ import annotations

from hotdesk.functions import business as rules
from hotdesk.operators.quality import WARN, Check
from hotdesk.schemas import SOURCES

BOTH = (True, False)


def _key(table: str, column: str) -> list[Check]:
    return [Check("unique", table, column), Check("not_null", table, column)]


def _clean() -> list[Check]:
    checks = [c for s in SOURCES.values() for c in _key(f"clean_{s.name}", s.id_column)]
    return [
        *checks,
        Check("not_null", "clean_bookings", "space_id"),
        Check("accepted_values", "clean_bookings", "is_cancelled", values=BOTH),
        Check("between", "clean_plans", "plan_value", WARN, minimum=0.0),
    ]


def _staging() -> list[Check]:
    histories = {
        "bookings": "booking",
        "spaces": "space",
        "companies": "company",
        "plans": "plan",
        "users": "user",
    }
    checks = []
    for name, entity in histories.items():
        checks += [
            Check("unique", f"stg_{name}", f"{entity}_stg_sk"),
            Check("not_null", f"stg_{name}", f"{entity}_id"),
        ]
    return [
        *checks,
        Check("not_null", "stg_bookings", "is_cancelled"),
        Check("column_type", "stg_bookings", "check_in_datetime", WARN, data_type="timestamp_ntz"),
        Check("not_null", "stg_companies", "company_size_tier"),
        Check("accepted_values", "stg_companies", "company_size_tier", values=rules.SIZE_TIERS),
        Check("not_null", "stg_users", "email_masked"),
        Check("not_null", "stg_users", "phone_masked"),
        Check(
            "row_rule",
            "stg_bookings",
            "check_in_datetime",
            condition="is_cancelled AND NOT is_no_show AND check_in_datetime IS NOT NULL",
        ),
    ]


def _core() -> list[Check]:
    checks = _key("fact_bookings", "booking_dw_sk") + _key("fact_bookings", "booking_id")
    checks += [Check("not_null", "fact_bookings", c) for c in ("company_id", "space_id", "user_id", "plan_id")]
    checks += [
        Check("relationships", "fact_bookings", "company_id", parent=("dim_companies", "company_id")),
        Check("relationships", "fact_bookings", "plan_id", parent=("dim_plans", "plan_id")),
        Check("accepted_values", "fact_bookings", "booking_status_derived", values=rules.BOOKING_STATUSES),
        Check("accepted_values", "fact_bookings", "is_cancelled", values=BOTH),
        Check("accepted_values", "fact_bookings", "is_no_show", values=BOTH),
    ]
    checks += _key("dim_spaces", "space_dw_sk")
    checks += [
        Check("not_null", "dim_spaces", "space_id"),
        Check("accepted_values", "dim_spaces", "is_current_version", values=BOTH),
    ]
    for name, entity in {"companies": "company", "plans": "plan", "users": "user"}.items():
        checks += _key(f"dim_{name}", f"{entity}_dw_sk") + _key(f"dim_{name}", f"{entity}_id")
    checks.append(Check("accepted_values", "dim_companies", "company_size_tier", values=rules.SIZE_TIERS))
    return checks


CHECKS: tuple[Check, ...] = (*_clean(), *_staging(), *_core())


def of_kind(*kinds: str) -> list[Check]:
    return [c for c in CHECKS if c.kind in kinds]


def of_table(table: str) -> list[Check]:
    return [c for c in CHECKS if c.table == table]
