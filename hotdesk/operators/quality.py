"""Declared data-quality checks and the reports built from them.

All row checks of a table share one scan.  Key checks aggregate before they
compare, so a key held by a large share of the rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.functions.business import rounded
from hotdesk.operators.incremental import timestamp_literal
from hotdesk.schemas import SourceTable

ERROR, WARN = "error", "warn"
# Column of the values that could not be typed.
REJECTS = "_rejects"
ROW_KINDS = ("not_null", "accepted_values", "between", "column_type", "row_rule")

# ---- fixed values: limits of the checks -------------------------------------
FRESHNESS_WARN_HOURS = 12
FRESHNESS_ERROR_HOURS = 24
CIRCUIT_BREAKER_RATE = 0.05
VOLUME_DAYS = 7
VOLUME_SHARE = 0.1
# ---- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared check; ``condition`` selects the failing rows of a row rule."""

    kind: str
    table: str
    column: str
    severity: str = ERROR
    values: tuple = ()
    minimum: float | None = None
    data_type: str | None = None
    parent: tuple[str, str] | None = None
    condition: str | None = None

    @property
    def check_id(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}"

    def row_fails(self) -> Column:
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return column.isNotNull() & ~column.isin(*self.values)
        if self.kind == "between":
            return column < self.minimum
        if self.kind == "column_type":
            return F.typeof(column) != self.data_type
        return F.expr(self.condition)


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row_failures(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """Failing rows of every row check of one table, counted in one pass."""
    counted = rows.agg(*[F.count_if(c.row_fails()).alias(c.check_id) for c in checks])
    pairs = F.array(
        *[F.struct(F.lit(c.check_id).alias("check_id"), F.col(f"`{c.check_id}`").alias("failures")) for c in checks]
    )
    return counted.select(F.inline(pairs))


def _duplicate_keys(rows: DataFrame, check: Check) -> DataFrame:
    key = F.col(check.column)
    repeated = rows.where(key.isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("failures")).select(F.lit(check.check_id).alias("check_id"), "failures")


def _orphans(rows: DataFrame, parents: DataFrame, check: Check) -> DataFrame:
    """Child rows whose key has no parent; children are counted per key before the join."""
    key = F.col(check.column)
    per_key = rows.where(key.isNotNull()).groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    known = parents.select(F.col(check.parent[1]).alias("_key"))
    return (
        per_key.join(known, "_key", "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        .select(F.lit(check.check_id).alias("check_id"), "failures")
    )


def failures(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """``(check_id, failures)`` for every check."""
    checks = list(checks)
    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        row_checks = [c for c in checks if c.table == name and c.kind in ROW_KINDS]
        if row_checks:
            parts.append(_row_failures(tables[name], row_checks))
    for check in checks:
        if check.kind == "unique":
            parts.append(_duplicate_keys(tables[check.table], check))
        elif check.kind == "relationships":
            parts.append(_orphans(tables[check.table], tables[check.parent[0]], check))
    return _union(parts)


def report(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check with its failures and ``pass`` / ``warn`` / ``error``."""
    checks = list(checks)
    by_id = {c.check_id: c for c in checks}

    def described(value) -> Column:
        pairs = [F.lit(v) for check_id, check in by_id.items() for v in (check_id, value(check))]
        return F.create_map(*pairs)[F.col("check_id")]

    severity = described(lambda c: c.severity)
    return failures(tables, checks).select(
        "check_id",
        described(lambda c: c.table).alias("table_name"),
        described(lambda c: c.column).alias("column_name"),
        described(lambda c: c.kind).alias("kind"),
        severity.alias("severity"),
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise(severity).alias("status"),
    )


def circuit_breaker(
    tables: Mapping[str, DataFrame], checks: Iterable[Check], limit: float = CIRCUIT_BREAKER_RATE
) -> DataFrame:
    """Per table: rows that fail any error-level row check, and whether to publish it."""
    checks = [c for c in checks if c.kind in ROW_KINDS and c.severity == ERROR]
    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        fails = [F.coalesce(c.row_fails(), F.lit(False)) for c in checks if c.table == name]
        counted = tables[name].agg(
            F.count("*").alias("checked_rows"), F.count_if(reduce(Column.__or__, fails)).alias("failing_rows")
        )
        parts.append(counted.select(F.lit(name).alias("table_name"), "*"))
    return _rated(_union(parts), limit)


def _rated(counted: DataFrame, limit: float) -> DataFrame:
    rate = F.coalesce(F.col("failing_rows") / F.nullif(F.col("checked_rows"), F.lit(0)), F.lit(0.0))
    return counted.select("*", rounded(rate, 4).alias("failure_rate"), (rate <= limit).alias("publish"))


def reject_rates(judged: Mapping[str, DataFrame], limit: float = CIRCUIT_BREAKER_RATE) -> DataFrame:
    """Per table: rows with a value that was set aside, and whether the rest may be loaded.

    The breaker's report over rows as ``hotdesk.plans.clean.judged`` leaves them.
    """
    parts = [
        rows.agg(F.count("*").alias("checked_rows"), F.count_if(F.size(REJECTS) > 0).alias("failing_rows")).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, rows in judged.items()
    ]
    return _rated(_union(parts), limit)


def source_freshness(
    landed: Mapping[str, DataFrame], sources: Mapping[str, SourceTable], as_of: datetime | None = None
) -> DataFrame:
    """Age in hours of the newest row of each source, by that source's own load column."""
    now = F.localtimestamp() if as_of is None else timestamp_literal(as_of)
    newest = _union(
        rows.agg(F.max(sources[name].watermark).alias("newest")).select(F.lit(name).alias("source_name"), "newest")
        for name, rows in landed.items()
    )
    age = F.call_function("div", now - F.col("newest"), F.expr("INTERVAL '1' HOUR"))
    minutes = F.call_function("div", now - F.col("newest"), F.expr("INTERVAL '1' MINUTE"))
    return newest.select(
        "source_name",
        "newest",
        age.alias("age_hours"),
        F.when(F.col("newest").isNull() | (minutes > FRESHNESS_ERROR_HOURS * 60), ERROR)
        .when(minutes > FRESHNESS_WARN_HOURS * 60, WARN)
        .otherwise("pass")
        .alias("status"),
    )


def daily_volumes(days: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and day on a calendar without gaps (a day without rows counts 0).

    ``days`` gives each table's days, one row per row of the table, in a column ``day``.  All
    tables are counted in one aggregation; the days up to the next one that has rows are put
    in beside each counted day, so nothing is read or joined a second time.
    """
    every = _union(rows.select(F.lit(name).alias("table_name"), "day") for name, rows in days.items())
    counts = every.where("day IS NOT NULL").groupBy("table_name", "day").agg(F.count("*").alias("n"))
    following = F.lead("day").over(Window.partitionBy("table_name").orderBy("day"))
    until = F.coalesce(F.date_sub("_next", 1), F.col("day"))
    filled = counts.withColumn("_next", following).select(
        "table_name", F.col("day").alias("_day"), "n", F.explode(F.sequence("day", until)).alias("day")
    )
    here = F.when(F.col("day") == F.col("_day"), F.col("n")).otherwise(0)
    return filled.select("table_name", "day", here.alias("row_count"))


def daily_volume(rows: DataFrame, table: str, day: Column) -> DataFrame:
    """The volumes of one table."""
    return daily_volumes({table: rows.select(day.alias("day"))})


def volume_anomaly(volumes: DataFrame) -> DataFrame:
    """Flags empty days and days under a tenth of the mean of the seven days before."""
    before = Window.partitionBy("table_name").orderBy("day").rowsBetween(-VOLUME_DAYS, -1)
    usual = F.avg("row_count").over(before)
    return volumes.select(
        "*",
        rounded(usual, 2).alias("mean_before"),
        (
            (F.col("row_count") == 0) | F.coalesce(F.col("row_count") < VOLUME_SHARE * usual, F.lit(False))
        ).alias("is_anomaly"),
    )


def contract(landed: Mapping[str, DataFrame], sources: Mapping[str, SourceTable]) -> DataFrame:
    """Declared against delivered columns, with rows and NULLs per delivered column.

    A declared column that is missing, a column of another type, and a column that
    nobody declared all break the contract; so does a NULL in the id column.
    """
    parts = []
    for name, rows in landed.items():
        declared = {f.name: f.dataType.simpleString() for f in sources[name].schema}
        delivered = {f.name: f.dataType.simpleString() for f in rows.schema}
        counted = rows.agg(
            F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in delivered]
        )
        lines = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(declared.get(column)).cast("string").alias("declared_type"),
                F.lit(delivered.get(column)).cast("string").alias("delivered_type"),
                F.col("_rows").alias("row_count"),
                (F.col(column) if column in delivered else F.lit(None).cast("bigint")).alias("null_count"),
                F.lit(column == sources[name].id_column).alias("is_required"),
            )
            for column in {**declared, **delivered}
        ]
        parts.append(counted.select(F.inline(F.array(*lines))))
    same_type = F.col("declared_type").eqNullSafe(F.col("delivered_type"))
    filled = ~F.col("is_required") | (F.coalesce("null_count", F.lit(0)) == 0)
    return _union(parts).select("*", (same_type & filled).alias("is_kept"))
