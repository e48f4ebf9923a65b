"""Credit utilisation of the last three months, churn candidates and space performance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.functions import business as rules
from hotdesk.operators.dates import date_of_id, month_of, weekdays_in_month
from hotdesk.operators.history import point_in_time_join

# Names of output columns, here and where rates are named below.
RATE = "taxa_utilizacao_perc"
CEILING = "teto_creditos_trimestre"
CONSUMED = "creditos_consumidos_trimestre"
COMPANY = ["company_id", "company_name", "company_size_tier"]
PLAN = ["plan_name", "plan_type"]


def day(as_of: date | None) -> Column:
    """The reference day: a literal (it prunes partitions), or today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def recent_bookings(fact: DataFrame, as_of: date | None) -> DataFrame:
    """Attended bookings of the window; rows with an unknown flag drop out."""
    since = F.add_months(day(as_of), -rules.MONTHS_IN_WINDOW)
    return fact.where((F.col("check_in_date") >= since) & ~F.col("is_cancelled") & ~F.col("is_no_show"))


def star_join(fact: DataFrame, companies: DataFrame, plans: DataFrame) -> DataFrame:
    return fact.join(companies, "company_id").join(plans, "plan_id")


def credits_by_company_plan(
    fact: DataFrame, companies: DataFrame, plans: DataFrame, as_of: date | None
) -> DataFrame:
    """Credits per company and plan attributes.

    Bookings are summed per (company_id, plan_id) before the joins, so neither
    join sees more than one row per pair, however busy a company or plan is.
    """
    per_pair = (
        recent_bookings(fact, as_of)
        .groupBy("company_id", "plan_id")
        .agg(F.sum("credits_used").alias("credits"))
    )
    joined = star_join(
        per_pair,
        companies.select(*COMPANY),
        plans.select("plan_id", *PLAN, "monthly_credits", "cost_per_credit"),
    )
    return joined.groupBy(
        *COMPANY, *PLAN, F.col("monthly_credits").alias("creditos_disponiveis_mensais"), "cost_per_credit"
    ).agg(F.sum("credits").alias(CONSUMED))


def utilization(grouped: DataFrame) -> DataFrame:
    ceiling = F.col("creditos_disponiveis_mensais") * rules.MONTHS_IN_WINDOW
    return grouped.select(
        *COMPANY,
        *PLAN,
        CONSUMED,
        ceiling.alias(CEILING),
        "cost_per_credit",
        rules.percent(F.col(CONSUMED), ceiling).alias(RATE),
    )


def network_average(rates: DataFrame) -> DataFrame:
    """One row: the unweighted mean of the known rates."""
    return rates.where(F.col(RATE).isNotNull()).agg(F.avg(RATE).alias("network_mean"))


def with_network_average(rates: DataFrame) -> DataFrame:
    """Adds the mean to every row; the joined side is a global aggregate, always one row."""
    return rates.crossJoin(F.broadcast(network_average(rates)))


def compared(rates: DataFrame) -> DataFrame:
    rate, mean = F.col(RATE), F.col("network_mean")
    return with_network_average(rates).select(
        *rates.columns,
        rules.rounded(mean).alias("media_geral_rede_perc"),
        rules.rounded(rate - mean).alias("delta_vs_media"),
        rules.engagement_status(rate, mean).alias("status_de_engajamento"),
    )


def credit_utilization_l3m(
    fact: DataFrame, companies: DataFrame, plans: DataFrame, as_of: date | None = None
) -> DataFrame:
    """One row per company and plan attributes, least used first."""
    return least_used_first(compared(utilization(credits_by_company_plan(fact, companies, plans, as_of))))


def least_used_first(rates: DataFrame) -> DataFrame:
    """Sorted by rate, unknown rates last.

    Equal rates go on by company and plan, which lets the sort split a rate that very
    many rows share over several range partitions.
    """
    return rates.orderBy(F.col(RATE).asc_nulls_last(), "company_id", *PLAN)


def churn_candidates(mart: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Rows under the threshold with risk level and action; an unknown rate is no candidate."""
    rate = F.col(RATE)
    return mart.where(rate < threshold).select(
        *mart.columns,
        rules.churn_risk_level(rate).alias("churn_risk_level"),
        rules.suggested_action(rate).alias("suggested_action"),
    )


def churn_summary(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("churn_risk_level").agg(
        F.count("*").alias("candidates"),
        F.min(RATE).alias("lowest_rate"),
        F.max(RATE).alias("highest_rate"),
    )


def monthly_sums(fact: DataFrame, *below: Column) -> DataFrame:
    """What is added up per space and month of ``date_id``, and below what else is given."""
    status = F.col("booking_status_derived")
    return fact.groupBy(*below, month_of(date_of_id(F.col("date_id"))).alias("date_month"), "space_id").agg(
        F.count("*").alias("bookings"),
        F.count_if(status.isin(rules.COMPLETED, rules.CHECKED_IN)).alias("check_ins"),
        F.count_if(status == rules.NO_SHOW).alias("no_shows"),
        F.sum(F.when(status == rules.COMPLETED, F.col("revenue_brl")).otherwise(0.0)).alias("revenue"),
    )


def added_up(sums: DataFrame) -> DataFrame:
    names = ("bookings", "check_ins", "no_shows", "revenue")
    return sums.groupBy("date_month", "space_id").agg(*[F.sum(n).alias(n) for n in names])


def space_performance_monthly(fact: DataFrame, dim_spaces: DataFrame) -> DataFrame:
    """Occupancy, revenue and no-shows per space and month of ``date_id``.

    Seats come from the space version valid on the first of the month.
    """
    return rated_spaces(monthly_sums(fact), dim_spaces)


def rated_spaces(monthly: DataFrame, dim_spaces: DataFrame) -> DataFrame:
    seated = point_in_time_join(
        monthly,
        dim_spaces,
        "space_id",
        F.col("date_month").cast("timestamp_ntz"),
        {"available_seats": "available_seats"},
        how="left",
    )
    capacity = F.col("available_seats") * weekdays_in_month(F.col("date_month"))
    return seated.select(
        "date_month",
        "space_id",
        "bookings",
        "check_ins",
        "available_seats",
        weekdays_in_month(F.col("date_month")).alias("weekdays"),
        rules.percent(F.col("check_ins"), capacity).alias("taxa_ocupacao_mensal_perc"),
        rules.rounded(F.col("revenue")).alias("receita_bruta_gerada_brl"),
        rules.percent(F.col("no_shows"), F.col("bookings")).alias("no_show_rate_perc"),
    )
