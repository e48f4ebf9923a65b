"""The nine landed tables: column types, keys, watermarks and contracts.

Column names and types are fixed by the landed data; everything the clean layer
needs (typed projection, surrogate key, incremental filter) is derived from the
declarations below.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SourceTable:
    """One landed table and how it is loaded."""

    name: str
    id_column: str
    sk_column: str
    watermark: str
    ddl: str

    @property
    def columns(self) -> list[tuple[str, str]]:
        """(name, type) pairs, readable without a session."""
        return [tuple(column.lower().split()) for column in self.ddl.split(",")]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def target_watermark(self) -> str:
        """Name of the watermark column once it is in the clean layer."""
        return f"source_{self.watermark}"


# ---- fixed values: landed column names and types ---------------------------
_TABLES = (
    SourceTable(
        "bookings", "booking_id", "booking_sk", "updated_at",
        """booking_id BIGINT, date_id BIGINT, space_id BIGINT, user_id BIGINT,
           company_id BIGINT, group_id BIGINT, plan_id BIGINT,
           booking_type_id BIGINT, status_id BIGINT,
           credits DOUBLE, credits_in_money DOUBLE,
           check_in_datetime TIMESTAMP_NTZ, check_out_datetime TIMESTAMP_NTZ,
           check_in_latitude DOUBLE, check_in_longitude DOUBLE,
           is_cancelled BOOLEAN, is_no_show BOOLEAN, is_future BOOLEAN,
           app_type STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "spaces", "space_id", "space_sk", "updated_at",
        """space_id BIGINT, space_name STRING, vanity_name STRING, country STRING,
           city STRING, neighborhood STRING, address STRING,
           latitude DOUBLE, longitude DOUBLE, timezone STRING,
           space_type STRING, category STRING, level STRING, tier STRING,
           total_seats INT, available_seats INT, total_private_rooms INT,
           is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "companies", "company_id", "company_sk", "updated_at",
        """company_id BIGINT, company_name STRING, industry STRING,
           employee_count INT, is_active BOOLEAN,
           created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "plans", "plan_id", "plan_sk", "updated_at",
        """plan_id BIGINT, plan_name STRING, plan_type STRING,
           monthly_credits INT, plan_value DOUBLE, is_active BOOLEAN,
           created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "users", "user_id", "user_sk", "updated_at",
        """user_id BIGINT, full_name STRING, email STRING, phone STRING,
           is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "status", "status_id", "status_sk", "created_at",
        """status_id BIGINT, status_name STRING, status_description STRING,
           created_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "booking_types", "booking_type_id", "booking_type_sk", "created_at",
        """booking_type_id BIGINT, type_name STRING, is_active BOOLEAN,
           created_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "office_groups", "group_id", "group_sk", "updated_at",
        """group_id BIGINT, group_name STRING,
           created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    ),
    SourceTable(
        "reasons", "reason_id", "reason_sk", "created_at",
        "reason_id BIGINT, reason_description STRING, created_at TIMESTAMP_NTZ",
    ),
)
# ---- end of fixed values ---------------------------------------------------

SOURCES: dict[str, SourceTable] = {t.name: t for t in _TABLES}
