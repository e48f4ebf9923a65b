"""Feature tables kept current by month: a load changes what it touches, and nothing else is read.

The fact's partitions say what a load touched: one that was rewritten reads another folder
than at the last refresh. Of the months touched, partial aggregates are made anew and stored
by month; the tables that users see are added up from these:

``user_months``     per month, user and app: counts, sums, counters per hour and weekday;
``user_places``     per month, user and neighbourhood: bookings and distances;
``space_months``    per month of ``date_id`` and space, below the month of check-in.

A booking's past changes with every earlier booking, so the wide table is made anew from the
first touched month on; what lies before comes from ``user_months``. A space version that
came, went or changed touches the months from its start on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.functions import business as rules
from hotdesk.operators.accumulate import first_maximum
from hotdesk.operators.dates import iso_weekday, month_of
from hotdesk.operators.history import point_in_time_join
from hotdesk.plans import analytics, features
from hotdesk.plans.features import CHECK_IN, HOURS
from hotdesk.sources.warehouse import Warehouse

MONTH = "_part_month"
DAYS = range(1, 8)
#: What the features take from a space's version.
VERSION = [
    "space_id", "valid_from", "valid_to", "available_seats", "tier", "total_seats", "city",
    "occupancy_rate_pct", "neighborhood", "latitude", "longitude",
]


def _in_month() -> Column:
    return month_of(F.to_date(CHECK_IN))


def user_months(fact: DataFrame) -> DataFrame:
    """Sums per month of check-in, user and app."""
    weekday = iso_weekday(F.col(CHECK_IN))
    return fact.groupBy(_in_month().alias(MONTH), "user_id", "app_type").agg(
        F.count("*").alias("bookings"),
        F.sum(F.col("is_no_show").cast("int")).alias("no_shows"),
        F.count("is_no_show").alias("known_shows"),
        F.sum(F.col("is_cancelled").cast("int")).alias("cancelled"),
        F.count("is_cancelled").alias("known_cancelled"),
        F.sum("duration_minutes").alias("minutes"),
        F.count("duration_minutes").alias("timed"),
        *[F.count_if(F.hour(CHECK_IN) == h).alias(f"hour_{h}") for h in HOURS],
        *[F.count_if(weekday == d).alias(f"day_{d}") for d in DAYS],
    )


def user_places(fact: DataFrame, dim_spaces: DataFrame) -> DataFrame:
    """Bookings and distances per month of check-in, user and neighbourhood."""
    point = ["check_in_latitude", "check_in_longitude"]
    placed = point_in_time_join(
        fact.where(F.col(CHECK_IN).isNotNull()).select("user_id", "space_id", CHECK_IN, *point),
        dim_spaces,
        "space_id",
        CHECK_IN,
        {"neighborhood": "neighborhood", "latitude": "_latitude", "longitude": "_longitude"},
    )
    km = rules.great_circle_km(*[F.col(c) for c in (*point, "_latitude", "_longitude")])
    return placed.groupBy(_in_month().alias(MONTH), "user_id", "neighborhood").agg(
        F.count("*").alias("bookings"), F.sum(km).alias("km"), F.count(km).alias("measured")
    )


def space_months(fact: DataFrame) -> DataFrame:
    """The sums of space performance, below the month of check-in that they come from."""
    return analytics.monthly_sums(fact, _in_month().alias(MONTH))


# ---- tables added up from the partial ones --------------------------------------


def _rate(part: str, whole: str) -> Column:
    return rules.rounded(rules.ratio(F.sum(part), F.sum(whole)), 4)


def _behaviour() -> list[Column]:
    return [
        F.sum("bookings").alias("bookings"),
        _rate("no_shows", "known_shows").alias("no_show_rate"),
        _rate("cancelled", "known_cancelled").alias("cancellation_rate"),
        rules.rounded(rules.ratio(F.sum("minutes"), F.sum("timed"))).alias("mean_duration"),
    ]


def _favourite(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Per user the value of most bookings, the lower one on a tie."""
    counted = rows.where(F.col(value).isNotNull()).groupBy("user_id", value).agg(F.sum("bookings").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value))).getField(value)
    return counted.groupBy(F.col("user_id").alias("_user")).agg(best.alias(name))


def _with(rows: DataFrame, other: DataFrame) -> DataFrame:
    return rows.join(other, F.col("user_id").eqNullSafe(F.col("_user")), "left").drop("_user")


def user_behavior(months: DataFrame) -> DataFrame:
    return _with(months.groupBy("user_id").agg(*_behaviour()), _favourite(months, "app_type", "favourite_app"))


def user_profile(months: DataFrame, places: DataFrame) -> DataFrame:
    days = F.array(*[F.struct((-F.sum(f"day_{d}")).alias("n"), F.lit(d).alias("day")) for d in DAYS])
    users = months.groupBy("user_id").agg(
        *_behaviour(), *[F.sum(f"hour_{h}").alias(f"hour_{h}") for h in HOURS], days.alias("_days")
    )
    used = F.filter(F.sort_array("_days"), lambda d: d["n"] < 0)
    distance = places.groupBy(F.col("user_id").alias("_user")).agg(
        rules.rounded(F.sum("km") / F.nullif(F.sum("measured"), F.lit(0)), 3).alias("mean_distance_km")
    )
    users = _with(_with(users, _favourite(places, "neighborhood", "favourite_neighborhood")), distance)
    return users.select(
        "user_id", "bookings", "no_show_rate", "cancellation_rate", "mean_duration",
        first_maximum([F.col(f"hour_{h}") for h in HOURS]).alias("preferred_hour"),
        "favourite_neighborhood", "mean_distance_km",
        F.get(used, F.lit(0))["day"].alias("favourite_weekday"),
        F.get(used, F.lit(1))["day"].alias("second_weekday"),
    )


def carried_into(months: DataFrame, first: date) -> DataFrame:
    """What the wide table carries over the start of a month, per user and app."""
    return months.where(F.col(MONTH) < F.lit(first)).groupBy("user_id", "app_type").agg(
        F.sum("bookings").alias("prior_bookings"),
        F.sum(F.coalesce("no_shows", F.lit(0))).alias("_no_shows"),
        F.sum(F.coalesce("minutes", F.lit(0))).alias("_minutes"),
        F.sum("timed").alias("_timed"),
        *[F.sum(f"hour_{h}").alias(f"_hour_{h}") for h in HOURS],
    )


# ---- refresh ----------------------------------------------------------------------


def _months(values) -> set[date | None]:
    """Months of partition values, which are days or first days of months."""
    return {date.fromisoformat(v).replace(day=1) if v else None for v in values}


def touched_months(
    warehouse: Warehouse, fact: str, layout: list[str], spaces: DataFrame
) -> tuple[set[date | None], DataFrame]:
    """Months that changed since the last refresh, and the state to remember for the next one."""
    now = warehouse.partition_folders(fact, layout)
    before: dict[tuple, str] = {}
    changed = None
    if warehouse.exists("feature_state"):
        # One row per partition of the fact.
        before = {tuple(r["partition"]): r["folder"] for r in warehouse.read("feature_state").toLocalIterator()}
        known = warehouse.read("feature_spaces")
        odd = spaces.exceptAll(known).unionByName(known.exceptAll(spaces))
        changed = odd.agg(F.min("valid_from")).first()[0]
    partitions = [p for p in {*now, *before} if now.get(p) != before.get(p)]
    touched = _months(p[0] for p in partitions)
    if changed is not None:
        touched |= {m for m in _months(p[0] for p in now) if m and m >= changed.date().replace(day=1)}
    state = warehouse.spark.createDataFrame(
        [(list(p), folder) for p, folder in now.items()], "partition array<string>, folder string"
    )
    return touched, state


def refresh(warehouse: Warehouse, fact: str, layout: list[str]) -> set[date | None]:
    """Brings the feature tables up to the fact; returns the months that were made anew.

    ``layout`` names the fact's partition columns; the first is a day or the first day of a
    month. The state is remembered last, so a refresh that broke off is made again.
    """
    bookings, dim_spaces = warehouse.read(fact), warehouse.read("dim_spaces").select(*VERSION)
    spaces = warehouse.stage("feature_spaces", dim_spaces)
    touched, state = touched_months(warehouse, fact, layout, spaces)
    if not touched:
        return touched

    def of(rows: DataFrame, column: str, months) -> DataFrame:
        known, month = [m for m in months if m], month_of(F.col(column))
        among = month.isin(known) if known else F.lit(False)
        return rows.where(among | month.isNull() if None in months else among)

    values = [(m,) for m in touched]
    changed = of(bookings, layout[0], touched)
    for table, rows in (
        ("user_months", user_months(changed)),
        ("user_places", user_places(changed, spaces)),
        ("space_months", space_months(changed)),
    ):
        warehouse.replace_partitions(table, rows.withColumnRenamed(MONTH, "month"), ["month"], values)
    months = warehouse.read("user_months").withColumnRenamed("month", MONTH)
    places = warehouse.read("user_places").withColumnRenamed("month", MONTH)
    warehouse.rebuild("user_behavior_features", user_behavior(months))
    warehouse.rebuild("user_profile_features", user_profile(months, places))
    warehouse.rebuild("dim_date", features.dim_date(bookings))
    warehouse.rebuild(
        "space_performance_monthly",
        analytics.rated_spaces(analytics.added_up(warehouse.read("space_months")), spaces),
    )
    dated = sorted(m for m in touched if m)
    if dated:
        first = dated[0]
        later = bookings.where(month_of(F.col(layout[0])) >= F.lit(first))
        wide = features.wide_booking_features(later, spaces, carried_into(months, first))
        every = {m for m in _months(p[0] for p in warehouse.partition_folders(fact, layout)) if m and m >= first}
        gone = [(m,) for m in {*every, *dated}]
        wide = wide.withColumn(MONTH, month_of(F.col("check_in_date")))
        warehouse.replace_partitions("wide_booking_features", wide, [MONTH], gone)
    warehouse.rebuild("feature_spaces", spaces)
    warehouse.rebuild("feature_state", state)
    return touched
