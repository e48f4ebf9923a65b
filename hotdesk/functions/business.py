"""Business rules as plain ``Column`` expressions (no UDFs, all inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: labels and limits that consumers rely on ----------------
CANCELLED, NO_SHOW, SCHEDULED = "cancelled", "no_show", "scheduled"
COMPLETED, CHECKED_IN, UNKNOWN = "completed", "checked_in", "unknown"
BOOKING_STATUSES = (CANCELLED, NO_SHOW, SCHEDULED, COMPLETED, CHECKED_IN, UNKNOWN)

SIZE_TIERS = ("Small", "Medium", "Large", "Enterprise")

ENGAGEMENT_CRITICAL = "Crítico (Risco Churn)"
ENGAGEMENT_BELOW = "Abaixo da Média"
ENGAGEMENT_ABOVE = "Acima da Média"
CRITICAL_UTILIZATION = 30.0

URGENT_UTILIZATION = 15.0
RISK_URGENT, RISK_HIGH = "CRITICAL", "HIGH"
ACTION_URGENT = "Agendar reunião urgente de retenção com CS"
ACTION_HIGH = "Acionar CS para reunião de engajamento"

MONTHS_IN_WINDOW = 3
EARTH_RADIUS_KM = 6371.0088
# ---- end of fixed values ---------------------------------------------------


def rounded(value: Column, digits: int = 2) -> Column:
    """Scales, rounds half away from zero, scales back.

    ``round(value, digits)`` works on the shortest decimal text of the double, which
    settles ties such as 1.265 differently from engines that scale first.
    """
    factor = float(10**digits)
    return F.round(value.cast("double") * factor) / factor


def round_money(amount: Column) -> Column:
    return rounded(amount, 2)


def revenue_brl(cents: Column) -> Column:
    """Integer cents to currency units."""
    return round_money(cents.cast("double") / 100.0)


def duration_minutes(started: Column, ended: Column) -> Column:
    """Whole elapsed minutes, signed; NULL if either end is missing.

    Dividing the interval keeps the arithmetic free of the session time zone.
    """
    return F.call_function("div", ended - started, F.expr("INTERVAL '1' MINUTE"))


def booking_status(
    cancelled: Column, no_show: Column, future: Column, check_in: Column, check_out: Column
) -> Column:
    """First rule that holds wins; a NULL flag counts as not set."""
    return (
        F.when(cancelled, CANCELLED)
        .when(no_show, NO_SHOW)
        .when(future, SCHEDULED)
        .when(check_in.isNotNull() & check_out.isNotNull(), COMPLETED)
        .when(check_in.isNotNull(), CHECKED_IN)
        .otherwise(UNKNOWN)
    )


def company_size_tier(employees: Column) -> Column:
    """Size class by head-count; an unknown head-count falls in the last class."""
    return (
        F.when(employees <= 50, "Small")
        .when(employees <= 200, "Medium")
        .when(employees <= 1000, "Large")
        .otherwise("Enterprise")
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as doubles that yields NULL on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return rounded(100.0 * ratio(numerator, denominator))


def cost_per_credit(plan_value: Column, monthly_credits: Column) -> Column:
    return F.when(monthly_credits > 0, round_money(ratio(plan_value, monthly_credits)))


def occupancy_rate_pct(total_seats: Column, available_seats: Column) -> Column:
    """Share of seats taken; 0.0 for a space without seats."""
    return F.when(total_seats > 0, percent(total_seats - available_seats, total_seats)).otherwise(0.0)


def engagement_status(utilization: Column, network_mean: Column) -> Column:
    """An unknown utilisation falls in the last class."""
    return (
        F.when(utilization < CRITICAL_UTILIZATION, ENGAGEMENT_CRITICAL)
        .when(utilization < network_mean, ENGAGEMENT_BELOW)
        .otherwise(ENGAGEMENT_ABOVE)
    )


def churn_risk_level(utilization: Column) -> Column:
    return F.when(utilization < URGENT_UTILIZATION, RISK_URGENT).otherwise(RISK_HIGH)


def suggested_action(utilization: Column) -> Column:
    return F.when(utilization < URGENT_UTILIZATION, ACTION_URGENT).otherwise(ACTION_HIGH)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle (haversine) distance."""
    half_chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(half_chord))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance rounded to metres."""
    return rounded(great_circle_km(lat1, lon1, lat2, lon2), 3)
