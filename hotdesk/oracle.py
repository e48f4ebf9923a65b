"""SQL twins of the registered queries, for an engine that runs ANSI SQL on the same tables.

Written against the given tables on its own, without the DataFrame code: relations
are common table expressions, and each query pulls in the ones that it names.
"""

from __future__ import annotations

import re
from typing import NamedTuple

class _Landed(NamedTuple):
    """A landed table as the twin expects it: id, surrogate key, load time, columns with types."""

    name: str
    id_column: str
    sk_column: str
    watermark: str
    ddl: str

    @property
    def columns(self) -> list[list[str]]:
        return [column.split() for column in self.ddl.split(",")]


# ---- fixed values: landed column names and types, spelled out on purpose ----
_LANDED = (
    _Landed(
        "bookings", "booking_id", "booking_sk", "updated_at",
        "booking_id bigint, date_id bigint, space_id bigint, user_id bigint, company_id bigint, group_id "
        "bigint, plan_id bigint, booking_type_id bigint, status_id bigint, credits double, "
        "credits_in_money double, check_in_datetime timestamp_ntz, check_out_datetime timestamp_ntz, "
        "check_in_latitude double, check_in_longitude double, is_cancelled boolean, is_no_show boolean, "
        "is_future boolean, app_type string, created_at timestamp_ntz, updated_at timestamp_ntz",
    ),
    _Landed(
        "spaces", "space_id", "space_sk", "updated_at",
        "space_id bigint, space_name string, vanity_name string, country string, city string, "
        "neighborhood string, address string, latitude double, longitude double, timezone string, "
        "space_type string, category string, level string, tier string, total_seats int, available_seats "
        "int, total_private_rooms int, is_active boolean, created_at timestamp_ntz, updated_at "
        "timestamp_ntz",
    ),
    _Landed(
        "companies", "company_id", "company_sk", "updated_at",
        "company_id bigint, company_name string, industry string, employee_count int, is_active boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz",
    ),
    _Landed(
        "plans", "plan_id", "plan_sk", "updated_at",
        "plan_id bigint, plan_name string, plan_type string, monthly_credits int, plan_value double, "
        "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz",
    ),
    _Landed(
        "users", "user_id", "user_sk", "updated_at",
        "user_id bigint, full_name string, email string, phone string, is_active boolean, created_at "
        "timestamp_ntz, updated_at timestamp_ntz",
    ),
    _Landed(
        "status", "status_id", "status_sk", "created_at",
        "status_id bigint, status_name string, status_description string, created_at timestamp_ntz",
    ),
    _Landed(
        "booking_types", "booking_type_id", "booking_type_sk", "created_at",
        "booking_type_id bigint, type_name string, is_active boolean, created_at timestamp_ntz",
    ),
    _Landed(
        "office_groups", "group_id", "group_sk", "updated_at",
        "group_id bigint, group_name string, created_at timestamp_ntz, updated_at timestamp_ntz",
    ),
    _Landed(
        "reasons", "reason_id", "reason_sk", "created_at",
        "reason_id bigint, reason_description string, created_at timestamp_ntz",
    ),
)
# ---- end of fixed values ----------------------------------------------------
SOURCES = {t.name: t for t in _LANDED}

NULL_KEY = "_dbt_utils_surrogate_key_null_"
AS_OF = "DATE '2001-08-01'"
SPLIT = "TIMESTAMP '2000-01-01 00:00:00'"
START = "TIMESTAMP '1995-01-01 00:00:00'"
_SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _sk(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _booking(day: str, **replaced: str) -> str:
    """Booking columns of an order, dated by ``day``."""
    columns = {
        "booking_id": "o_orderkey",
        "date_id": f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS BIGINT)",
        "space_id": "o_orderkey % (SELECT count(*) FROM supplier)",
        "user_id": "o_custkey",
        "company_id": "o_custkey",
        "group_id": "o_orderkey % 25",
        "plan_id": "(o_custkey + o_orderkey % 3) % (SELECT count(*) FROM part)",
        "booking_type_id": "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
        "status_id": "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 99 END AS BIGINT)",
        "credits": "CAST(1 + o_orderkey % 400 AS DOUBLE)",
        "credits_in_money": "CAST(floor(o_totalprice) AS DOUBLE)",
        "check_in_datetime": f"""CASE WHEN o_orderkey % 23 <> 0 THEN
            {day} + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 AS INTEGER) END""",
        "check_out_datetime": f"""CASE WHEN o_orderkey % 23 <> 0 AND o_orderkey % 19 <> 0 THEN
            {day} + INTERVAL 1 MINUTE * CAST(o_orderkey % 1440 + 30 + (o_orderkey * 7) % 480 AS INTEGER)
            + INTERVAL 1 SECOND * CAST(o_orderkey % 60 AS INTEGER) END""",
        "check_in_latitude": "CAST(-23.0 AS DOUBLE) + CAST(o_orderkey % 1000 AS DOUBLE) / 1000",
        "check_in_longitude": "CAST(-46.0 AS DOUBLE) + CAST(o_orderkey % 700 AS DOUBLE) / 1000",
        "is_cancelled": "o_orderkey % 10 = 0",
        "is_no_show": "o_orderkey % 11 = 0",
        "is_future": "o_orderkey % 17 = 0",
        "app_type": "CASE o_orderkey % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END",
        "created_at": day,
        "updated_at": day,
        **replaced,
    }
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _hours(key: str) -> str:
    return f"{START} + INTERVAL 1 HOUR * CAST({key} % 20000 AS INTEGER)"


def _clean(name: str) -> str:
    source = SOURCES[name]
    columns = ", ".join(
        f"{column} AS source_{column}" if column in ("created_at", "updated_at") else column
        for column, _ in source.columns
    )
    return f"""SELECT {_sk(source.id_column)} AS {source.sk_column}, {columns} FROM raw_{name}
        QUALIFY row_number() OVER (PARTITION BY {source.id_column} ORDER BY {source.watermark} DESC NULLS LAST) = 1"""


def _stg_bookings(rows: str) -> str:
    return f"""SELECT {_sk('b.booking_id', 'b.source_updated_at')} AS booking_stg_sk,
        b.booking_id, b.date_id, b.space_id, b.user_id, b.company_id, b.group_id, b.plan_id,
        b.booking_type_id, b.status_id, s.status_name, t.type_name AS booking_type_name,
        b.credits, b.credits_in_money, round(b.credits_in_money / 100.0, 2) AS revenue_brl,
        b.check_in_datetime, b.check_out_datetime, CAST(b.check_in_datetime AS DATE) AS check_in_date,
        date_sub('minute', b.check_in_datetime, b.check_out_datetime) AS duration_minutes,
        b.check_in_latitude, b.check_in_longitude, b.is_cancelled, b.is_no_show, b.is_future, b.app_type,
        {_STATUS} AS booking_status_derived, b.source_created_at, b.source_updated_at
        FROM {rows} b LEFT JOIN clean_status s ON b.status_id = s.status_id
        LEFT JOIN clean_booking_types t ON b.booking_type_id = t.booking_type_id"""


# The labels and classes of the rules, here and in the statements below.
_STATUS = """CASE WHEN is_cancelled THEN 'cancelled' WHEN is_no_show THEN 'no_show' WHEN is_future THEN 'scheduled'
        WHEN check_in_datetime IS NOT NULL AND check_out_datetime IS NOT NULL THEN 'completed'
        WHEN check_in_datetime IS NOT NULL THEN 'checked_in' ELSE 'unknown' END"""
_TIER = """CASE WHEN employee_count <= 50 THEN 'Small' WHEN employee_count <= 200 THEN 'Medium'
        WHEN employee_count <= 1000 THEN 'Large' ELSE 'Enterprise' END"""
_COST = "CASE WHEN monthly_credits > 0 THEN round(plan_value / CAST(monthly_credits AS DOUBLE), 2) END"
_OCCUPANCY = """CASE WHEN total_seats > 0 THEN
        round(100.0 * (CAST(total_seats - available_seats AS DOUBLE) / CAST(total_seats AS DOUBLE)), 2)
        ELSE 0.0 END"""
_EMAIL = "CASE WHEN contains(email, '@') THEN substr(email, 1, 3) || '***@' || split_part(email, '@', 2) END"
_PHONE = """CASE WHEN phone IS NULL THEN NULL WHEN length(phone) >= 4 THEN '***' || right(phone, 4)
        ELSE '***' END"""
_KM = """2 * 6371.0088 * asin(sqrt(pow(sin(radians(latitude - check_in_latitude) / 2), 2)
        + cos(radians(check_in_latitude)) * cos(radians(latitude))
        * pow(sin(radians(longitude - check_in_longitude) / 2), 2)))"""
_SPACE_COLUMNS = """space_id, space_name, vanity_name, country, city, neighborhood, address, latitude, longitude,
        timezone, space_type, category, level, tier, total_seats, available_seats, total_private_rooms"""


def _stg_spaces(rows: str) -> str:
    columns = ", ".join(f"sp.{c.strip()}" for c in _SPACE_COLUMNS.split(","))
    return f"""SELECT {_sk('sp.space_id', 'sp.source_updated_at')} AS space_stg_sk, {columns},
        {_OCCUPANCY} AS occupancy_rate_pct, g.group_name AS office_group_name, sp.is_active,
        sp.source_created_at, sp.source_updated_at
        FROM {rows} sp LEFT JOIN clean_office_groups g ON sp.space_id = g.group_id"""


def _fact(rows: str) -> str:
    return f"""SELECT {_sk('booking_id')} AS booking_dw_sk, booking_id, date_id, space_id, user_id, company_id,
        group_id, plan_id, booking_type_id, status_id, status_name, booking_type_name, credits AS credits_used,
        credits_in_money, revenue_brl, check_in_datetime, check_out_datetime, check_in_date, duration_minutes,
        check_in_latitude, check_in_longitude, is_cancelled, is_no_show, is_future, app_type,
        booking_status_derived, source_created_at AS created_at, source_updated_at AS updated_at
        FROM {rows} QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY source_updated_at DESC) = 1"""


_RELATIONS: dict[str, str] = {
    # landed tables
    "raw_bookings": f"SELECT {_booking('o_orderdate')} FROM orders",
    "raw_spaces": """SELECT space_id, s_name AS space_name, lower(s_name) AS vanity_name, 'Brasil' AS country,
        n_name AS city, 'Bairro ' || CAST(space_id % 12 AS VARCHAR) AS neighborhood,
        'Rua ' || CAST(space_id AS VARCHAR) AS address,
        CAST(-23.0 AS DOUBLE) + CAST(space_id % 100 AS DOUBLE) / 100 AS latitude,
        CAST(-46.0 AS DOUBLE) + CAST(space_id % 70 AS DOUBLE) / 100 AS longitude,
        'America/Sao_Paulo' AS timezone,
        CASE WHEN space_id % 2 = 0 THEN 'coworking' ELSE 'office' END AS space_type,
        'category ' || CAST(space_id % 4 AS VARCHAR) AS category,
        'level ' || CAST(space_id % 3 AS VARCHAR) AS level, 'tier' || CAST(n % 3 AS VARCHAR) AS tier,
        total_seats, available_seats, CAST(space_id % 5 AS INTEGER) AS total_private_rooms,
        s_acctbal >= 0 AS is_active, {start} AS created_at, updated_at
        FROM (SELECT l_suppkey AS space_id, CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS updated_at,
            CAST(max(l_quantity) AS INTEGER) AS total_seats, CAST(min(l_quantity) AS INTEGER) AS available_seats,
            count(*) AS n FROM lineitem GROUP BY ALL) v
        JOIN supplier ON space_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey""".replace("{start}", START),
    "raw_companies": f"""SELECT c_custkey AS company_id, c_name AS company_name, lower(c_mktsegment) AS industry,
        CAST(CASE WHEN c_custkey % 97 <> 0 THEN 1 + (c_custkey * 37) % 1500 END AS INTEGER) AS employee_count,
        c_acctbal >= 0 AS is_active, {START} AS created_at, {_hours('c_custkey')} AS updated_at FROM customer""",
    "raw_plans": f"""SELECT p_partkey AS plan_id, p_name || ' ' || p_brand AS plan_name, lower(p_type) AS plan_type,
        CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 20 END AS INTEGER) AS monthly_credits,
        p_retailprice AS plan_value, p_size % 7 <> 0 AS is_active, {START} AS created_at,
        {_hours('p_partkey')} AS updated_at FROM part""",
    "raw_users": f"""SELECT c_custkey AS user_id, c_name AS full_name,
        CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN lower(c_name)
            ELSE 'u' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.example' END AS email,
        CASE WHEN c_custkey % 37 = 0 THEN '123'
            ELSE '+55' || lpad(CAST((c_custkey * 7919) % 1000000000 AS VARCHAR), 9, '0') END AS phone,
        c_acctbal >= 0 AS is_active, {START} AS created_at, {_hours('c_custkey')} AS updated_at FROM customer""",
    "raw_status": """SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS status_id,
        CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Completed' ELSE 'No-show' END AS status_name,
        'order status ' || o_orderstatus AS status_description, min(o_orderdate) AS created_at
        FROM orders GROUP BY o_orderstatus""",
    "raw_booking_types": """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS booking_type_id,
        substr(o_orderpriority, 3) AS type_name, true AS is_active, min(o_orderdate) AS created_at
        FROM orders GROUP BY o_orderpriority""",
    "raw_office_groups": f"""SELECT CAST(n_nationkey AS BIGINT) AS group_id, n_name AS group_name,
        {START} AS created_at, {_hours('n_nationkey')} AS updated_at FROM nation""",
    "raw_reasons": """SELECT min(event_id) AS reason_id, 'reason: ' || event_type AS reason_description,
        min(ts) AS created_at FROM events GROUP BY event_type""",
    "raw_changes": f"""SELECT {_booking(
        'l_shipdate', credits='shipped', is_cancelled='returned')}
        FROM orders JOIN (SELECT l_orderkey, l_shipdate, max(l_quantity) AS shipped,
            bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY ALL) ON o_orderkey = l_orderkey""",
    # clean layer
    **{f"clean_{name}": _clean(name) for name in SOURCES},
    # staging layer
    "stg_bookings": _stg_bookings("clean_bookings"),
    "typed_changes": "SELECT * EXCLUDE (created_at, updated_at), created_at AS source_created_at, "
    "updated_at AS source_updated_at FROM raw_changes",
    "stg_changes": _stg_bookings("typed_changes"),
    "typed_spaces": "SELECT * EXCLUDE (created_at, updated_at), created_at AS source_created_at, "
    "updated_at AS source_updated_at FROM raw_spaces",
    "stg_spaces": _stg_spaces("typed_spaces"),
    "stg_companies": f"""SELECT {_sk('company_id', 'source_updated_at')} AS company_stg_sk, * EXCLUDE (company_sk),
        {_TIER} AS company_size_tier FROM clean_companies""",
    "stg_plans": f"""SELECT {_sk('plan_id', 'source_updated_at')} AS plan_stg_sk, * EXCLUDE (plan_sk),
        {_COST} AS cost_per_credit FROM clean_plans""",
    "stg_users": f"""SELECT {_sk('user_id', 'source_updated_at')} AS user_stg_sk,
        * EXCLUDE (user_sk, email, phone), {_EMAIL} AS email_masked, {_PHONE} AS phone_masked FROM clean_users""",
    "stg_status": f"SELECT {_sk('status_id')} AS status_stg_sk, * EXCLUDE (status_sk) FROM clean_status",
    "stg_booking_types": f"""SELECT {_sk('booking_type_id')} AS booking_type_stg_sk, * EXCLUDE (booking_type_sk)
        FROM clean_booking_types""",
    "stg_office_groups": f"SELECT {_sk('group_id')} AS group_stg_sk, * EXCLUDE (group_sk) FROM clean_office_groups",
    "stg_reasons": f"SELECT {_sk('reason_id')} AS reason_stg_sk, * EXCLUDE (reason_sk) FROM clean_reasons",
    # star schema
    "fact_bookings": _fact("stg_bookings"),
    "fact_changes": _fact("stg_changes"),
    **{
        f"dim_{plural}": f"""SELECT {_sk(f'{one}_id')} AS {one}_dw_sk,
        * EXCLUDE ({one}_stg_sk, source_created_at, source_updated_at),
        source_created_at AS created_at, source_updated_at AS updated_at FROM stg_{plural}"""
        for one, plural in (("company", "companies"), ("plan", "plans"), ("user", "users"))
    },
    "dim_spaces": f"""SELECT {_sk('space_id', 'source_updated_at')} AS space_dw_sk, {_SPACE_COLUMNS},
        occupancy_rate_pct, office_group_name, is_active, source_updated_at AS valid_from,
        coalesce(lead(source_updated_at) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
        lead(source_updated_at) OVER w IS NULL AS is_current_version
        FROM stg_spaces WINDOW w AS (PARTITION BY space_id ORDER BY source_updated_at)""",
    # utilisation
    "recent": f"""SELECT * FROM fact_bookings
        WHERE check_in_date >= CAST({AS_OF} - INTERVAL 3 MONTH AS DATE) AND NOT is_cancelled AND NOT is_no_show""",
    "credits": """SELECT company_id, company_name, company_size_tier, plan_name, plan_type,
        monthly_credits AS creditos_disponiveis_mensais, cost_per_credit,
        sum(credits_used) AS creditos_consumidos_trimestre
        FROM recent JOIN dim_companies USING (company_id) JOIN dim_plans USING (plan_id) GROUP BY ALL""",
    "rates": """SELECT company_id, company_name, company_size_tier, plan_name, plan_type,
        creditos_consumidos_trimestre, creditos_disponiveis_mensais * 3 AS teto_creditos_trimestre, cost_per_credit,
        round(100.0 * (creditos_consumidos_trimestre
            / nullif(CAST(creditos_disponiveis_mensais * 3 AS DOUBLE), 0.0)), 2) AS taxa_utilizacao_perc
        FROM credits""",
    "network": "SELECT avg(taxa_utilizacao_perc) AS mean FROM rates",
    "mart": """SELECT rates.*, round(mean, 2) AS media_geral_rede_perc,
        round(taxa_utilizacao_perc - mean, 2) AS delta_vs_media,
        CASE WHEN taxa_utilizacao_perc < 30.0 THEN 'Crítico (Risco Churn)'
            WHEN taxa_utilizacao_perc < mean THEN 'Abaixo da Média' ELSE 'Acima da Média' END
            AS status_de_engajamento
        FROM rates CROSS JOIN network""",
    "churn": """SELECT *, CASE WHEN taxa_utilizacao_perc < 15.0 THEN 'CRITICAL' ELSE 'HIGH' END AS churn_risk_level,
        CASE WHEN taxa_utilizacao_perc < 15.0 THEN 'Agendar reunião urgente de retenção com CS'
            ELSE 'Acionar CS para reunião de engajamento' END AS suggested_action
        FROM mart WHERE taxa_utilizacao_perc < 30.0""",
}

_PIT = """fact_bookings b JOIN dim_spaces s ON b.space_id = s.space_id
        AND b.check_in_datetime >= s.valid_from AND b.check_in_datetime < s.valid_to"""


def _check(kind: str, table: str, column: str, severity: str, failures: str) -> str:
    return f"""SELECT '{kind}:{table}.{column}' AS check_id, '{table}' AS table_name, '{column}' AS column_name,
        '{kind}' AS kind, '{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"""


def _status_of(lines: list[str]) -> str:
    union = " UNION ALL ".join(lines)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({union})"


_IDS = {s.name: s.id_column for s in SOURCES.values()}
_ENTITIES = {"bookings": "booking", "spaces": "space", "companies": "company", "plans": "plan", "users": "user"}
_UNIQUE = [
    *[(f"clean_{name}", key) for name, key in _IDS.items()],
    *[(f"stg_{many}", f"{one}_stg_sk") for many, one in _ENTITIES.items()],
    ("fact_bookings", "booking_dw_sk"),
    ("fact_bookings", "booking_id"),
    ("dim_spaces", "space_dw_sk"),
    ("dim_companies", "company_dw_sk"),
    ("dim_companies", "company_id"),
    ("dim_plans", "plan_dw_sk"),
    ("dim_plans", "plan_id"),
    ("dim_users", "user_dw_sk"),
    ("dim_users", "user_id"),
]
_NOT_NULL = [
    *[(f"clean_{name}", key) for name, key in _IDS.items()],
    ("clean_bookings", "space_id"),
    *[(f"stg_{many}", f"{one}_id") for many, one in _ENTITIES.items()],
    ("stg_bookings", "is_cancelled"),
    ("stg_companies", "company_size_tier"),
    ("stg_users", "email_masked"),
    ("stg_users", "phone_masked"),
    *[("fact_bookings", c) for c in ("booking_dw_sk", "booking_id", "company_id", "space_id", "user_id", "plan_id")],
    ("dim_spaces", "space_dw_sk"),
    ("dim_spaces", "space_id"),
    *[("dim_companies", c) for c in ("company_dw_sk", "company_id")],
    *[("dim_plans", c) for c in ("plan_dw_sk", "plan_id")],
    *[("dim_users", c) for c in ("user_dw_sk", "user_id")],
]
_BOTH = "true, false"
_TIERS = "'Small', 'Medium', 'Large', 'Enterprise'"
# The accepted labels.
_ACCEPTED = [
    ("clean_bookings", "is_cancelled", _BOTH),
    ("stg_companies", "company_size_tier", _TIERS),
    (
        "fact_bookings",
        "booking_status_derived",
        "'cancelled', 'no_show', 'scheduled', 'completed', 'checked_in', 'unknown'",
    ),
    ("fact_bookings", "is_cancelled", _BOTH),
    ("fact_bookings", "is_no_show", _BOTH),
    ("dim_spaces", "is_current_version", _BOTH),
    ("dim_companies", "company_size_tier", _TIERS),
]
_PARENTS = [("company_id", "dim_companies"), ("plan_id", "dim_plans")]

_UNIQUE_LINES = [
    _check(
        "unique", t, c, "error",
        f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
    )
    for t, c in _UNIQUE
]
_NOT_NULL_LINES = [
    _check("not_null", t, c, "error", f"SELECT count(*) FROM {t} WHERE {c} IS NULL") for t, c in _NOT_NULL
]
_ACCEPTED_LINES = [
    _check("accepted_values", t, c, "error", f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({v})")
    for t, c, v in _ACCEPTED
]
_PARENT_LINES = [
    _check(
        "relationships", "fact_bookings", c, "error",
        f"SELECT count(*) FROM fact_bookings f WHERE f.{c} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {p} d WHERE d.{c} = f.{c})",
    )
    for c, p in _PARENTS
]
_BETWEEN_LINES = [
    _check("between", "clean_plans", "plan_value", "warn", "SELECT count(*) FROM clean_plans WHERE plan_value < 0")
]
_TYPE_LINES = [
    _check(
        "column_type", "stg_bookings", "check_in_datetime", "warn",
        "SELECT count(*) FROM stg_bookings WHERE typeof(check_in_datetime) <> 'TIMESTAMP'",
    )
]
_CANCELLED = "is_cancelled AND NOT is_no_show AND check_in_datetime IS NOT NULL"
_RULE_LINES = [
    _check(
        "row_rule", "stg_bookings", "check_in_datetime", "error",
        f"SELECT count(*) FROM stg_bookings WHERE {_CANCELLED}",
    )
]


def _breaker() -> str:
    fails: dict[str, list[str]] = {}
    for t, c in _NOT_NULL:
        fails.setdefault(t, []).append(f"{c} IS NULL")
    for t, c, values in _ACCEPTED:
        fails.setdefault(t, []).append(f"{c} NOT IN ({values})")
    fails["stg_bookings"].append(f"({_CANCELLED})")
    lines = [
        f"""SELECT '{t}' AS table_name, count(*) AS checked_rows,
        count(*) FILTER (WHERE {' OR '.join(conditions)}) AS failing_rows FROM {t}"""
        for t, conditions in fails.items()
    ]
    rate = "coalesce(failing_rows / nullif(checked_rows, 0), 0.0)"
    return f"""SELECT *, round({rate}, 4) AS failure_rate, {rate} <= 0.05 AS publish
        FROM ({' UNION ALL '.join(lines)})"""


def _freshness() -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{s.name}' AS source_name, max({s.watermark}) AS newest FROM raw_{s.name}" for s in SOURCES.values()
    )
    now = "TIMESTAMP '2001-08-01 00:00:00'"
    return f"""SELECT source_name, newest, date_sub('hour', newest, {now}) AS age_hours,
        CASE WHEN newest IS NULL OR date_sub('minute', newest, {now}) > 1440 THEN 'error'
            WHEN date_sub('minute', newest, {now}) > 720 THEN 'warn' ELSE 'pass' END AS status FROM ({lines})"""


def _volume() -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{t.name}' AS table_name, CAST({t.watermark} AS DATE) AS day FROM raw_{t.name}"
        for t in SOURCES.values()
    )
    return f"""WITH loads AS ({lines}),
        counts AS (SELECT table_name, day, count(*) AS n FROM loads WHERE day IS NOT NULL GROUP BY ALL),
        span AS (SELECT table_name, min(day) AS first, max(day) AS last FROM counts GROUP BY ALL),
        calendar AS (SELECT table_name,
            CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
        daily AS (SELECT table_name, day, coalesce(n, 0) AS row_count
            FROM calendar LEFT JOIN counts USING (table_name, day))
        SELECT *, round(avg(row_count) OVER w, 2) AS mean_before,
        row_count = 0 OR coalesce(row_count < 0.1 * avg(row_count) OVER w, false) AS is_anomaly
        FROM daily WINDOW w AS (PARTITION BY table_name ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""


def _contract() -> str:
    lines = []
    for source in SOURCES.values():
        for column, kind in source.columns:
            required = str(column == source.id_column).lower()
            lines.append(
                f"""SELECT '{source.name}' AS table_name, '{column}' AS column_name, '{kind}' AS declared_type,
            any_value(CASE typeof({column}) WHEN '{_SQL_TYPES[kind]}' THEN '{kind}' ELSE 'other' END)
            AS delivered_type, count(*) AS row_count, count(*) - count({column}) AS null_count,
            {required} AS is_required FROM raw_{source.name}"""
            )
    return f"""SELECT *, declared_type = delivered_type AND (NOT is_required OR null_count = 0) AS is_kept
        FROM ({' UNION ALL '.join(lines)})"""


_PROFILE = """WITH placed AS (SELECT b.*, s.neighborhood, s.latitude, s.longitude
            FROM fact_bookings b LEFT JOIN dim_spaces s ON b.space_id = s.space_id
            AND b.check_in_datetime >= s.valid_from AND b.check_in_datetime < s.valid_to),
        days AS (SELECT user_id, CAST(isodow(check_in_datetime) AS INTEGER) AS d, count(*) AS n FROM placed
            WHERE check_in_datetime IS NOT NULL GROUP BY ALL),
        ranked_days AS (SELECT user_id, d, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, d) AS r FROM days),
        hours AS (SELECT user_id, CAST(hour(check_in_datetime) AS INTEGER) AS h, count(*) AS n FROM placed
            WHERE check_in_datetime IS NOT NULL GROUP BY ALL),
        ranked_hours AS (SELECT user_id, h, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, h) AS r
            FROM hours),
        areas AS (SELECT user_id, neighborhood, count(*) AS n FROM placed
            WHERE neighborhood IS NOT NULL GROUP BY ALL),
        ranked_areas AS (SELECT user_id, neighborhood,
            row_number() OVER (PARTITION BY user_id ORDER BY n DESC, neighborhood) AS r FROM areas)
        SELECT p.user_id, count(*) AS bookings,
        round(avg(CAST(CAST(is_no_show AS INTEGER) AS DOUBLE)), 4) AS no_show_rate,
        round(avg(CAST(CAST(is_cancelled AS INTEGER) AS DOUBLE)), 4) AS cancellation_rate,
        round(avg(duration_minutes), 2) AS mean_duration, any_value(h.h) AS preferred_hour,
        any_value(a.neighborhood) AS favourite_neighborhood, round(avg({km}), 3) AS mean_distance_km,
        any_value(d1.d) AS favourite_weekday, any_value(d2.d) AS second_weekday
        FROM placed p
        LEFT JOIN ranked_days d1 ON d1.user_id = p.user_id AND d1.r = 1
        LEFT JOIN ranked_days d2 ON d2.user_id = p.user_id AND d2.r = 2
        LEFT JOIN ranked_hours h ON h.user_id = p.user_id AND h.r = 1
        LEFT JOIN ranked_areas a ON a.user_id = p.user_id AND a.r = 1
        GROUP BY p.user_id""".replace("{km}", _KM)


_APPS = ("android", "ios", "web")


def _prior_counts(value: str, among) -> str:
    return ", ".join(f"count(*) FILTER ({value} = {v!r}) OVER w" for v in among)

_FINAL: dict[str, str] = {
    "scan_sources": " UNION ALL ".join(
        f"SELECT '{name}' AS source_name, count(*) AS row_count FROM raw_{name}" for name in SOURCES
    ),
    "typed_projection": """SELECT * EXCLUDE (created_at, updated_at), created_at AS source_created_at,
        updated_at AS source_updated_at FROM raw_bookings""",
    "surrogate_key": f"""SELECT booking_id, {_sk('booking_id')} AS one_part,
        {_sk('booking_id', 'updated_at')} AS two_parts, {_sk('booking_id', 'check_in_datetime')} AS nullable_part
        FROM raw_bookings""",
    "read_json_array": "SELECT * FROM mart",
    "revenue_brl": """SELECT booking_id, credits_in_money, round(credits_in_money / 100.0, 2) AS revenue_brl
        FROM raw_bookings""",
    "round_money": "SELECT booking_id, round(credits_in_money / 300, 2) AS third_of_amount FROM raw_bookings",
    "duration_minutes": """SELECT booking_id,
        date_sub('minute', check_in_datetime, check_out_datetime) AS duration_minutes,
        date_sub('minute', check_out_datetime, check_in_datetime) AS reversed_minutes FROM raw_bookings""",
    "booking_status": f"SELECT booking_id, {_STATUS} AS booking_status_derived FROM raw_bookings",
    "rolling_3m_filter": "SELECT booking_id, check_in_date FROM recent",
    "star_join": """SELECT booking_id, credits_used, company_name, company_size_tier, plan_name, plan_type
        FROM fact_bookings JOIN dim_companies USING (company_id) JOIN dim_plans USING (plan_id)""",
    "credits_by_company_plan": "SELECT * FROM credits",
    "safe_ratio": "SELECT company_id, plan_name, teto_creditos_trimestre, taxa_utilizacao_perc FROM rates",
    "network_average": "SELECT round(mean, 2) AS media_geral_rede_perc FROM network",
    "scalar_cross_join": """SELECT company_id, plan_name, taxa_utilizacao_perc,
        round(mean, 2) AS media_geral_rede_perc FROM rates CROSS JOIN network""",
    "delta_vs_mean": "SELECT company_id, plan_name, taxa_utilizacao_perc, delta_vs_media FROM mart",
    "engagement_status": """SELECT status_de_engajamento, count(*) AS companies,
        count(taxa_utilizacao_perc) AS with_known_rate, max(taxa_utilizacao_perc) AS highest_rate
        FROM mart GROUP BY ALL""",
    "utilization_sorted": """SELECT company_id, plan_name, taxa_utilizacao_perc FROM rates
        ORDER BY taxa_utilizacao_perc NULLS LAST""",
    "credit_utilization_l3m": "SELECT * FROM mart ORDER BY taxa_utilizacao_perc NULLS LAST",
    **{f"clean_{name}": f"SELECT * FROM clean_{name}" for name in SOURCES},
    "left_lookup_status": """SELECT booking_id, b.status_id, status_name
        FROM clean_bookings b LEFT JOIN clean_status s ON b.status_id = s.status_id""",
    "left_lookup_types": """SELECT booking_id, b.booking_type_id, type_name AS booking_type_name
        FROM clean_bookings b LEFT JOIN clean_booking_types t ON b.booking_type_id = t.booking_type_id""",
    "left_lookup_groups": """SELECT space_id, group_name AS office_group_name
        FROM clean_spaces LEFT JOIN clean_office_groups ON space_id = group_id""",
    "company_size_tier": f"SELECT company_id, employee_count, {_TIER} AS company_size_tier FROM raw_companies",
    "cost_per_credit": f"SELECT plan_id, monthly_credits, plan_value, {_COST} AS cost_per_credit FROM raw_plans",
    "occupancy_rate": f"SELECT space_id, updated_at, {_OCCUPANCY} AS occupancy_rate_pct FROM raw_spaces",
    "mask_email": f"SELECT user_id, {_EMAIL} AS email_masked FROM raw_users",
    "mask_phone": f"SELECT user_id, {_PHONE} AS phone_masked FROM raw_users",
    **{f"stg_{name}": f"SELECT * FROM stg_{name}" for name in SOURCES},
    "fact_bookings": "SELECT * FROM fact_bookings",
    **{f"dim_{name}": f"SELECT * FROM dim_{name}" for name in ("companies", "plans", "users", "spaces")},
    "daily_dim_spaces": "SELECT * FROM dim_spaces",
    "scd2_lead": """SELECT space_id, updated_at,
        lead(updated_at) OVER (PARTITION BY space_id ORDER BY updated_at) AS next_updated_at FROM raw_spaces""",
    "current_spaces": "SELECT space_dw_sk, space_id, tier, valid_from FROM dim_spaces WHERE is_current_version",
    "point_in_time_join": f"""SELECT b.user_id, b.booking_id, b.check_in_date, b.duration_minutes, b.credits_used,
        s.tier AS tier_na_epoca, s.total_seats AS seats_na_epoca, s.city, s.occupancy_rate_pct
        FROM {_PIT} WHERE NOT is_cancelled AND NOT is_no_show""",
    "churn_candidates": "SELECT * FROM churn",
    "churn_summary": """SELECT churn_risk_level, count(*) AS candidates, min(taxa_utilizacao_perc) AS lowest_rate,
        max(taxa_utilizacao_perc) AS highest_rate FROM churn GROUP BY ALL""",
    "export_json_roundtrip": "SELECT * FROM churn",
    "export_csv_roundtrip": "SELECT * FROM churn",
    "latest_per_key": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
        l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "incremental_filter": f"""SELECT booking_id, updated_at FROM raw_bookings
        WHERE updated_at > (SELECT max(updated_at) FROM raw_bookings WHERE updated_at < {SPLIT})""",
    "upsert_merge": """SELECT *, CAST(date_trunc('month', check_in_date) AS DATE) AS check_in_month
        FROM fact_changes""",
    "append_only": "SELECT * FROM stg_spaces",
    "schema_sync": f"""SELECT booking_id, credits, CASE WHEN updated_at >= {SPLIT} THEN app_type END AS app_type,
        updated_at AS source_updated_at FROM raw_bookings""",
    "typed_with_rejects": """WITH spoilt AS (SELECT CASE WHEN booking_id % 110 <> 0 THEN booking_id END AS booking_id,
            CASE WHEN booking_id % 50 <> 0 THEN status_id END AS status_id,
            CASE WHEN booking_id % 70 <> 0 THEN credits END AS credits, check_in_datetime, credits AS c
            FROM raw_bookings)
        SELECT booking_id, status_id, credits, check_in_datetime, concat_ws(',',
            CASE WHEN booking_id IS NULL THEN 'booking_id:missing' END,
            CASE WHEN status_id IS NULL THEN 'status_id:n/a:no bigint' END,
            CASE WHEN credits IS NULL THEN 'credits:' || CAST(c AS VARCHAR) || 'x:no double' END) AS rejects
        FROM spoilt""",
    "schema_sync_types": "SELECT booking_id, status_id, credits, updated_at AS source_updated_at FROM raw_bookings",
    "mat_full_rebuild": "SELECT * FROM mart",
    "partition_pruned_scan": """SELECT check_in_date, count(*) AS bookings, sum(credits_used) AS credits_used
        FROM recent GROUP BY ALL""",
    "dq_unique": _status_of(_UNIQUE_LINES),
    "dq_not_null": _status_of(_NOT_NULL_LINES),
    "dq_accepted_values": _status_of(_ACCEPTED_LINES),
    "dq_relationships": _status_of(_PARENT_LINES),
    "dq_between": _status_of(_BETWEEN_LINES),
    "dq_column_type": _status_of(_TYPE_LINES),
    "dq_no_checkin_on_cancelled": f"""SELECT booking_id, is_cancelled, is_no_show, check_in_datetime
        FROM stg_bookings WHERE {_CANCELLED}""",
    "dq_report": _status_of(
        _UNIQUE_LINES
        + _NOT_NULL_LINES
        + _ACCEPTED_LINES
        + _PARENT_LINES
        + _BETWEEN_LINES
        + _TYPE_LINES
        + _RULE_LINES
    ),
    "source_freshness": _freshness(),
    "space_performance_monthly": """WITH monthly AS (SELECT
            CAST(date_trunc('month', strptime(CAST(date_id AS VARCHAR), '%Y%m%d')) AS DATE) AS date_month, space_id,
            count(*) AS bookings,
            count(*) FILTER (WHERE booking_status_derived IN ('completed', 'checked_in')) AS check_ins,
            count(*) FILTER (WHERE booking_status_derived = 'no_show') AS no_shows,
            sum(CASE WHEN booking_status_derived = 'completed' THEN revenue_brl ELSE 0.0 END) AS revenue
            FROM fact_bookings GROUP BY ALL),
        seated AS (SELECT m.*, s.available_seats, CAST(len(list_filter(
                generate_series(date_month, last_day(date_month), INTERVAL 1 DAY), lambda d: isodow(d) < 6))
                AS INTEGER) AS weekdays
            FROM monthly m LEFT JOIN dim_spaces s ON m.space_id = s.space_id
            AND m.date_month >= s.valid_from AND m.date_month < s.valid_to)
        SELECT date_month, space_id, bookings, check_ins, available_seats, weekdays,
        round(100.0 * (CAST(check_ins AS DOUBLE) / nullif(CAST(available_seats * weekdays AS DOUBLE), 0.0)), 2)
            AS taxa_ocupacao_mensal_perc,
        round(revenue, 2) AS receita_bruta_gerada_brl,
        round(100.0 * (CAST(no_shows AS DOUBLE) / nullif(CAST(bookings AS DOUBLE), 0.0)), 2) AS no_show_rate_perc
        FROM seated""",
    "user_behavior_features": """WITH apps AS (SELECT user_id, app_type, count(*) AS n FROM fact_bookings GROUP BY ALL),
        ranked AS (SELECT user_id, app_type,
            row_number() OVER (PARTITION BY user_id ORDER BY n DESC, app_type) AS r FROM apps)
        SELECT f.user_id, count(*) AS bookings,
        round(avg(CAST(CAST(is_no_show AS INTEGER) AS DOUBLE)), 4) AS no_show_rate,
        round(avg(CAST(CAST(is_cancelled AS INTEGER) AS DOUBLE)), 4) AS cancellation_rate,
        round(avg(duration_minutes), 2) AS mean_duration, any_value(a.app_type) AS favourite_app
        FROM fact_bookings f JOIN ranked a ON a.user_id = f.user_id AND a.r = 1 GROUP BY f.user_id""",
    "wide_booking_features": f"""WITH past AS (SELECT *, count(*) OVER w AS prior_bookings,
            coalesce(sum(CAST(is_no_show AS INTEGER)) OVER w, 0) AS no_shows,
            coalesce(sum(duration_minutes) OVER w, 0) AS minutes, count(duration_minutes) OVER w AS timed,
            [{_prior_counts("hour(check_in_datetime)", range(24))}] AS hours,
            [{_prior_counts("app_type", _APPS)}] AS apps
            FROM fact_bookings WHERE check_in_datetime IS NOT NULL
            WINDOW w AS (PARTITION BY user_id ORDER BY check_in_datetime, booking_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT b.user_id, b.booking_id, b.check_in_date, b.duration_minutes, b.credits_used, b.app_type,
        s.tier AS tier_na_epoca, s.total_seats AS seats_na_epoca, s.city, s.occupancy_rate_pct,
        round({_KM}, 3) AS distance_km, prior_bookings,
        round(CAST(no_shows AS DOUBLE) / nullif(CAST(prior_bookings AS DOUBLE), 0.0), 4) AS prior_no_show_rate,
        round(CAST(minutes AS DOUBLE) / nullif(CAST(timed AS DOUBLE), 0.0), 2) AS prior_mean_duration,
        CASE WHEN prior_bookings > 0 THEN CAST(list_position(hours, list_max(hours)) - 1 AS INTEGER) END
            AS prior_preferred_hour,
        CASE WHEN list_max(apps) > 0 THEN ({list(_APPS)})[list_position(apps, list_max(apps))] END
            AS prior_favourite_app
        FROM {_PIT.replace('fact_bookings', 'past')} WHERE NOT is_cancelled AND NOT is_no_show""",
    "user_profile_features": _PROFILE,
    "dim_date": """WITH days AS (SELECT CAST(unnest(generate_series(
            strptime(CAST(min(date_id) AS VARCHAR), '%Y%m%d'), strptime(CAST(max(date_id) AS VARCHAR), '%Y%m%d'),
            INTERVAL 1 DAY)) AS DATE) AS date FROM fact_bookings)
        SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS BIGINT) AS date_id, date,
        CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
        CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) AS INTEGER) AS iso_weekday,
        isodow(date) < 6 AS is_weekday FROM days""",
    "bookings_stream": "SELECT * FROM fact_changes",
    "dq_volume_anomaly": _volume(),
    "dq_circuit_breaker": _breaker(),
    "dq_contract": _contract(),
    **{
        key: """SELECT l_suppkey AS space_id, CAST(l_quantity AS INTEGER) AS available_seats,
        l_shipdate AS changed_at, l_orderkey AS change_id, l_linenumber AS change_line FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
            l_linenumber DESC, l_quantity DESC) = 1"""
        for key in ("seats_cdc_latest", "seats_cdc_stream")
    },
}


def _needed(sql: str) -> list[str]:
    """Relations that a statement reads, directly or not, in the order of definition."""
    found: set[str] = set()
    open_ = [sql]
    while open_:
        words = set(re.findall(r"\w+", re.sub(r"'[^']*'", "", open_.pop())))
        for name in words & _RELATIONS.keys() - found:
            found.add(name)
            open_.append(_RELATIONS[name])
    return [name for name in _RELATIONS if name in found]


def _statement(sql: str) -> str:
    relations = ", ".join(f"{name} AS ({_RELATIONS[name]})" for name in _needed(sql))
    if not relations:
        return sql
    return f"WITH {relations} SELECT * FROM ({sql})"



for _table, _kept in (
    ("wide_booking_features", "features_two_loads"),
    ("user_profile_features", "profiles_two_loads"),
    ("space_performance_monthly", "space_months_two_loads"),
):
    _FINAL[_kept] = _FINAL[_table]

ORACLE: dict[str, str] = {name: _statement(sql) for name, sql in _FINAL.items()}
