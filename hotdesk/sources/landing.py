"""The nine landed tables, derived from the given order, part and event tables.

This stands in for the loader that would land them; every table is a DataFrame
job over the whole of its inputs, cast to the declared schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hotdesk.operators.dates import date_id_of
from hotdesk.schemas import SOURCES

START = "TIMESTAMP_NTZ'1995-01-01 00:00:00'"
UNMATCHED_STATUS = 99


# Column names and types of the given tables (fixed values).
GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landed table in its declared schema."""
    return _in_schema(name, _DERIVATIONS[name](spark, sf_dir))


def _in_schema(name: str, rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*[f"CAST({column} AS {kind}) AS {column}" for column, kind in SOURCES[name].columns])


def all_landed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: landed(spark, sf_dir, name) for name in SOURCES}


def booking_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several versions per booking: each shipped day of an order updates its booking.

    A change moves the check-in to the shipped day, so merged rows change partition.
    """
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_shipdate").agg(
        F.max("l_quantity").alias("shipped_quantity"),
        F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
    )
    changed = table(spark, sf_dir, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    bookings = _booking_columns(changed, spark, sf_dir, F.col("l_shipdate"))
    bookings = bookings.withColumns(
        {"credits": F.col("shipped_quantity"), "is_cancelled": F.col("returned"), "updated_at": F.col("l_shipdate")}
    )
    return _in_schema("bookings", bookings)


def _minutes_after(day: Column, minutes: Column) -> Column:
    return day + minutes.cast("int") * F.expr("INTERVAL '1' MINUTE")


def _booking_columns(orders: DataFrame, spark: SparkSession, sf_dir: str, day: Column) -> DataFrame:
    key = F.col("o_orderkey")
    spaces = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    plans = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    status = F.col("o_orderstatus")
    seconds = (key % 60).cast("int") * F.expr("INTERVAL '1' SECOND")
    checked_in = key % 23 != 0
    checked_out = checked_in & (key % 19 != 0)
    return orders.withColumns(
        {
            "booking_id": key,
            "date_id": date_id_of(day),
            "space_id": key % spaces,
            "user_id": F.col("o_custkey"),
            "company_id": F.col("o_custkey"),
            "group_id": key % 25,
            "plan_id": (F.col("o_custkey") + key % 3) % plans,
            "booking_type_id": F.substring("o_orderpriority", 1, 1),
            "status_id": F.when(status == "F", 1).when(status == "O", 2).otherwise(UNMATCHED_STATUS),
            "credits": 1 + key % 400,
            "credits_in_money": F.floor("o_totalprice"),
            "check_in_datetime": F.when(checked_in, _minutes_after(day, key % 1440)),
            "check_out_datetime": F.when(
                checked_out, _minutes_after(day, key % 1440 + 30 + (key * 7) % 480) + seconds
            ),
            "check_in_latitude": -23.0 + (key % 1000) / 1000,
            "check_in_longitude": -46.0 + (key % 700) / 1000,
            "is_cancelled": key % 10 == 0,
            "is_no_show": key % 11 == 0,
            "is_future": key % 17 == 0,
            "app_type": F.when(key % 3 == 0, "ios").when(key % 3 == 1, "android").otherwise("web"),
            "created_at": day,
            "updated_at": day,
        }
    )


def _bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _booking_columns(table(spark, sf_dir, "orders"), spark, sf_dir, F.col("o_orderdate"))


def _hours_after_start(key: str) -> Column:
    return F.expr(f"{START} + INTERVAL '1' HOUR * cast({key} % 20000 as int)")


def _companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.lower("c_mktsegment").alias("industry"),
        F.when(key % 97 != 0, 1 + (key * 37) % 1500).alias("employee_count"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.expr(START).alias("created_at"),
        _hours_after_start("c_custkey").alias("updated_at"),
    )


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("plan_id"),
        F.concat("p_name", F.lit(" "), "p_brand").alias("plan_name"),
        F.lower("p_type").alias("plan_type"),
        F.when(F.col("p_size") % 10 == 0, 0).otherwise(F.col("p_size") * 20).alias("monthly_credits"),
        F.col("p_retailprice").alias("plan_value"),
        (F.col("p_size") % 7 != 0).alias("is_active"),
        F.expr(START).alias("created_at"),
        _hours_after_start("p_partkey").alias("updated_at"),
    )


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    email = (
        F.when(key % 29 == 0, None)
        .when(key % 31 == 0, F.lower("c_name"))
        .otherwise(F.concat(F.lit("u"), key.cast("string"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")))
    )
    digits = F.lpad(((key * 7919) % 1_000_000_000).cast("string"), 9, "0")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("full_name"),
        email.alias("email"),
        F.when(key % 37 == 0, "123").otherwise(F.concat(F.lit("+55"), digits)).alias("phone"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.expr(START).alias("created_at"),
        _hours_after_start("c_custkey").alias("updated_at"),
    )


def _spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per space and shipped year."""
    versions = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("space_id"), F.year("l_shipdate").alias("year"))
        .agg(
            F.max("l_quantity").alias("total_seats"),
            F.min("l_quantity").alias("available_seats"),
            F.count("*").alias("n"),
        )
    )
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    key = F.col("space_id")
    return (
        versions.join(supplier, F.col("space_id") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key,
            F.col("s_name").alias("space_name"),
            F.lower("s_name").alias("vanity_name"),
            F.lit("Brasil").alias("country"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("Bairro "), (key % 12).cast("string")).alias("neighborhood"),
            F.concat(F.lit("Rua "), key.cast("string")).alias("address"),
            (-23.0 + (key % 100) / 100).alias("latitude"),
            (-46.0 + (key % 70) / 100).alias("longitude"),
            F.lit("America/Sao_Paulo").alias("timezone"),
            F.when(key % 2 == 0, "coworking").otherwise("office").alias("space_type"),
            F.concat(F.lit("category "), (key % 4).cast("string")).alias("category"),
            F.concat(F.lit("level "), (key % 3).cast("string")).alias("level"),
            F.concat(F.lit("tier"), (F.col("n") % 3).cast("string")).alias("tier"),
            "total_seats",
            "available_seats",
            (key % 5).alias("total_private_rooms"),
            (F.col("s_acctbal") >= 0).alias("is_active"),
            F.expr(START).alias("created_at"),
            F.make_date("year", F.lit(1), F.lit(1)).alias("updated_at"),
        )
    )


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").groupBy(status).agg(F.min("o_orderdate").alias("created_at")).select(
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("status_id"),
        F.when(status == "F", "Confirmed").when(status == "O", "Completed").otherwise("No-show").alias("status_name"),
        F.concat(F.lit("order status "), status).alias("status_description"),
        "created_at",
    )


def _booking_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").groupBy(priority).agg(F.min("o_orderdate").alias("created_at")).select(
        F.substring(priority, 1, 1).alias("booking_type_id"),
        F.substr(priority, F.lit(3)).alias("type_name"),
        F.lit(True).alias("is_active"),
        "created_at",
    )


def _office_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("group_id"),
        F.col("n_name").alias("group_name"),
        F.expr(START).alias("created_at"),
        _hours_after_start("n_nationkey").alias("updated_at"),
    )


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.min("event_id").alias("reason_id"), F.min("ts").alias("created_at")
    ).withColumn("reason_description", F.concat(F.lit("reason: "), "event_type"))


_DERIVATIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bookings": _bookings,
    "spaces": _spaces,
    "companies": _companies,
    "plans": _plans,
    "users": _users,
    "status": _status,
    "booking_types": _booking_types,
    "office_groups": _office_groups,
    "reasons": _reasons,
}
