"""Feature tables per user and per booking, and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.functions import business as rules
from hotdesk.operators.accumulate import first_maximum, leader, prior_totals, with_prior_count
from hotdesk.operators.dates import date_id_of, date_of_id, iso_weekday
from hotdesk.operators.history import point_in_time_join

CHECK_IN = "check_in_datetime"
_POINT = ["check_in_latitude", "check_in_longitude"]
HOURS = range(24)


def attended(fact: DataFrame) -> DataFrame:
    return fact.where(~F.col("is_cancelled") & ~F.col("is_no_show"))


def booking_at_the_time(fact: DataFrame, dim_spaces: DataFrame) -> DataFrame:
    """Attended bookings with the space as it was at check-in."""
    bookings = attended(fact).select(
        "user_id", "booking_id", "check_in_date", "duration_minutes", "credits_used", "space_id", CHECK_IN
    )
    return point_in_time_join(
        bookings,
        dim_spaces,
        "space_id",
        CHECK_IN,
        {  # fixed values: names of output columns
            "tier": "tier_na_epoca",
            "total_seats": "seats_na_epoca",
            "city": "city",
            "occupancy_rate_pct": "occupancy_rate_pct",
        },
    ).drop("space_id", CHECK_IN)


def _measures() -> dict[str, Column]:
    """What is added up of a user's bookings that have a check-in."""
    return {
        "prior_bookings": F.lit(1),
        "_no_shows": F.coalesce(F.col("is_no_show"), F.lit(False)).cast("int"),
        "_minutes": F.coalesce("duration_minutes", F.lit(0)),
        "_timed": F.col("duration_minutes").isNotNull().cast("int"),
        **{f"_hour_{h}": (F.hour(CHECK_IN) == h).cast("int") for h in HOURS},
    }


def with_the_past(dated: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Adds what is known of the user's earlier bookings: totals, a counter per hour, the leading app.

    ``carried`` has the measures' sums of bookings that lie before all of these, per user and app.
    """
    order = [CHECK_IN, "booking_id"]
    counted = dated.select("user_id", CHECK_IN)
    known = with_prior_count(dated, "user_id", CHECK_IN, order, "app_type", "_same_app", counted)
    led = {"_leading_app": leader(F.col("_same_app"), F.col("app_type"))}
    if carried is None:
        return prior_totals(known, "user_id", CHECK_IN, order, _measures(), led, counted)
    names = list(_measures())
    apps = carried.select(
        F.col("user_id").alias("_user"), F.col("app_type").alias("_app"), F.col("prior_bookings").alias("_carried")
    )
    same = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("app_type").eqNullSafe(F.col("_app"))
    known = known.join(apps, same, "left").withColumn(
        "_same_app", F.col("_same_app") + F.coalesce("_carried", F.lit(0))
    )
    past = prior_totals(
        known.drop("_user", "_app", "_carried"),
        "user_id",
        CHECK_IN,
        order,
        _measures(),
        led,
        counted,
    )
    led = F.when(F.col("app_type").isNotNull(), F.struct((-F.col("prior_bookings")).alias("_n"), F.col("app_type").alias("_value")))
    users = carried.groupBy(F.col("user_id").alias("_user")).agg(
        *[F.sum(n).alias(f"_carried_{n}") for n in names], F.min(led).alias("_carried_app")
    )
    joined = past.join(users, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    return joined.select(
        *dated.columns,
        *[(F.col(n) + F.coalesce(f"_carried_{n}", F.lit(0))).alias(n) for n in names],
        F.least("_leading_app", "_carried_app").alias("_leading_app"),
    )


def wide_booking_features(
    fact: DataFrame, dim_spaces: DataFrame, carried: DataFrame | None = None
) -> DataFrame:
    """One row per attended booking: space at the time, distance, and the user's past.

    Of the past hours and apps the one used most is told, the lower on a tie.  The past covers all earlier bookings of the user that have a check-in time,
    cancelled and missed ones too, and never the row itself; ``carried`` stands for bookings
    before those of ``fact``.
    """
    dated = fact.where(F.col(CHECK_IN).isNotNull()).select(
        "user_id", "booking_id", "check_in_date", "duration_minutes", "credits_used", "app_type",
        "space_id", CHECK_IN, *_POINT, "is_cancelled", "is_no_show",
    )
    # Told here, in five columns, what is known of the past goes through the join with the spaces.
    past = with_the_past(dated, carried).select(
        *dated.columns,
        "prior_bookings",
        rules.rounded(rules.ratio(F.col("_no_shows"), F.col("prior_bookings")), 4).alias("prior_no_show_rate"),
        rules.rounded(rules.ratio(F.col("_minutes"), F.col("_timed"))).alias("prior_mean_duration"),
        first_maximum([F.col(f"_hour_{h}") for h in HOURS]).alias("prior_preferred_hour"),
        F.col("_leading_app._value").alias("prior_favourite_app"),
    )
    placed = point_in_time_join(
        attended(past).drop("is_cancelled", "is_no_show"),
        dim_spaces,
        "space_id",
        CHECK_IN,
        {
            "tier": "tier_na_epoca",
            "total_seats": "seats_na_epoca",
            "city": "city",
            "occupancy_rate_pct": "occupancy_rate_pct",
            "latitude": "_latitude",
            "longitude": "_longitude",
        },
        counted=attended(dated),
    )
    return placed.select(
        "user_id",
        "booking_id",
        "check_in_date",
        "duration_minutes",
        "credits_used",
        "app_type",
        "tier_na_epoca",
        "seats_na_epoca",
        "city",
        "occupancy_rate_pct",
        rules.distance_km(*[F.col(c) for c in (*_POINT, "_latitude", "_longitude")]).alias("distance_km"),
        "prior_bookings",
        "prior_no_show_rate",
        "prior_mean_duration",
        "prior_preferred_hour",
        "prior_favourite_app",
    )


def _behaviour() -> list[Column]:
    return [
        F.count("*").alias("bookings"),
        rules.rounded(F.avg(F.col("is_no_show").cast("double")), 4).alias("no_show_rate"),
        rules.rounded(F.avg(F.col("is_cancelled").cast("double")), 4).alias("cancellation_rate"),
        rules.rounded(F.avg("duration_minutes")).alias("mean_duration"),
    ]


def user_behavior_features(fact: DataFrame) -> DataFrame:
    """Counts and rates per user, and the app used most (first by name on a tie)."""
    return fact.groupBy("user_id").agg(*_behaviour(), F.mode("app_type", deterministic=True).alias("favourite_app"))


def user_profile_features(fact: DataFrame, dim_spaces: DataFrame) -> DataFrame:
    """Habits per user in one aggregation.

    Favourites go by count, then by the lower value.  Weekdays are counted into
    seven columns, so the group state stays bounded whatever the group's size.
    """
    placed = point_in_time_join(
        fact.select(
            "user_id", "space_id", CHECK_IN, *_POINT, "is_no_show", "is_cancelled", "duration_minutes"
        ),
        dim_spaces,
        "space_id",
        CHECK_IN,
        {"neighborhood": "neighborhood", "latitude": "_latitude", "longitude": "_longitude"},
        how="left",
    )
    weekday = iso_weekday(F.col(CHECK_IN))
    per_user = placed.groupBy("user_id").agg(
        *_behaviour(),
        F.mode(F.hour(CHECK_IN), deterministic=True).alias("preferred_hour"),
        F.mode("neighborhood", deterministic=True).alias("favourite_neighborhood"),
        rules.rounded(
            F.avg(rules.great_circle_km(*[F.col(c) for c in (*_POINT, "_latitude", "_longitude")])), 3
        ).alias("mean_distance_km"),
        F.array(
            *[F.struct((-F.count_if(weekday == d)).alias("n"), F.lit(d).alias("day")) for d in range(1, 8)]
        ).alias("_days"),
    )
    used = F.filter(F.sort_array("_days"), lambda d: d["n"] < 0)
    return per_user.withColumns(
        {"favourite_weekday": F.get(used, F.lit(0))["day"], "second_weekday": F.get(used, F.lit(1))["day"]}
    ).drop("_days")


def dim_date(fact: DataFrame) -> DataFrame:
    """Every day between the first and the last ``date_id``."""
    span = fact.agg(F.min("date_id").alias("first"), F.max("date_id").alias("last"))
    days = span.select(F.explode(F.sequence(date_of_id(F.col("first")), date_of_id(F.col("last")))).alias("date"))
    date = F.col("date")
    return days.select(
        date_id_of(date).alias("date_id"),
        "date",
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        iso_weekday(date).alias("iso_weekday"),
        (iso_weekday(date) < 6).alias("is_weekday"),
    )
