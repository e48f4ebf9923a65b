"""The daily load: every table of the warehouse in dependency order.

Each step reads what is new since its own watermark, checks the result, and
publishes it.  A failed error-level check raises before the table is published,
so nothing downstream runs on bad rows and readers keep yesterday's table.

Merges go by natural id: the surrogate key is a hash of it, at four times the bytes.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hotdesk.operators import quality
from hotdesk.operators.incremental import newer_than
from hotdesk.plans import analytics, core, feature_store, staging
from hotdesk.plans.checks import of_table
from hotdesk.plans.clean import accepted, clean, every_version, judged, rejects
from hotdesk.schemas import SOURCES
from hotdesk.sources.files import export_csv, export_json, write_json_arrays
from hotdesk.sources.warehouse import Gate, Warehouse

HISTORIES = ("bookings", "spaces", "companies", "plans", "users")
LOOKUPS = {"bookings": ("clean_status", "clean_booking_types"), "spaces": ("clean_office_groups",)}
CLEAN_PARTITION = {"bookings": "date_id"}
FACT_PARTITION = "check_in_date"
# Bookings without a check-in, whatever their number, lie below the month they were made for.
FACT_LAYOUT = [FACT_PARTITION, "_part_month"]
MART = "mart_credit_utilization_l3m"


class ChecksFailed(RuntimeError):
    """A table was not published because an error-level check failed."""


def gate_for(warehouse: Warehouse, table: str) -> Gate:
    """Runs the declared checks of a table on rows about to be published."""
    checks = of_table(table)

    def gate(rows: DataFrame) -> None:
        if not checks:
            return
        parents = {c.parent[0]: warehouse.read(c.parent[0]) for c in checks if c.parent}
        failed = quality.report({table: rows, **parents}, checks).where(F.col("status") == quality.ERROR)
        lines = [f"{r['check_id']}: {r['failures']}" for r in failed.collect()]
        if lines:
            raise ChecksFailed("; ".join(lines))

    return gate


def laid_out_fact(stg_bookings: DataFrame) -> DataFrame:
    fact = core.fact_bookings(stg_bookings)
    return fact.withColumn(FACT_LAYOUT[1], F.floor(F.col("date_id") / 100).cast("int"))


def run(
    warehouse: Warehouse,
    landed: Mapping[str, DataFrame],
    as_of: date | None = None,
    full_refresh: bool = False,
    blocking_checks: bool = True,
    quarantine: bool = False,
) -> None:
    """Loads what is new in the landed tables into every layer.

    With ``quarantine``, values that do not fit their declared type are set aside in
    ``rejected_values`` and their rows are left out, unless too many rows of a table have one.
    A landed table that breaks its contract stops the load before anything is cast.  What
    the checks of freshness and volume found is kept in ``source_report``.
    """
    if quarantine:
        landed = set_aside(warehouse, landed)
    if blocking_checks:
        keep_contract(landed)

    def gate(table: str) -> Gate | None:
        return gate_for(warehouse, table) if blocking_checks else None

    def since(table: str) -> datetime | None:
        return None if full_refresh else warehouse.loaded_through(table)

    def keyed(
        table: str, rows: DataFrame, key: str, watermark: str, partition: str | list[str] | None = None
    ) -> None:
        if full_refresh or not warehouse.exists(table):
            if partition:
                warehouse.rebuild_partitions(table, rows, partition, watermark, gate(table))
            else:
                warehouse.rebuild(table, rows, watermark, gate(table))
            return
        batch = warehouse.stage(table, rows)
        if batch.isEmpty():
            return
        if partition:
            warehouse.upsert_partitions(table, batch, [key], partition, watermark, gate(table))
        else:
            warehouse.upsert(table, batch, [key], watermark, gate(table))

    for name, source in SOURCES.items():
        table = f"clean_{name}"
        batch = clean(source, landed[name], since(table))
        keyed(table, batch, source.id_column, source.target_watermark, CLEAN_PARTITION.get(name))

    for name, source in SOURCES.items():
        table = f"stg_{name}"
        if name == "spaces":
            # Every landed version belongs to the history; the clean table holds the current one alone.
            new = every_version(source, landed[name], since(table))
        else:
            new = newer_than(warehouse.read(f"clean_{name}"), source.target_watermark, since(table))
        batch = getattr(staging, name)(new, *[warehouse.read(t) for t in LOOKUPS.get(name, ())])
        if name in HISTORIES:
            warehouse.append(table, batch, source.target_watermark, gate(table), restart=full_refresh)
        else:
            keyed(table, batch, source.id_column, source.target_watermark)

    for table, name, build, partition in (
        ("dim_companies", "companies", core.dim_companies, None),
        ("dim_plans", "plans", core.dim_plans, None),
        ("dim_users", "users", core.dim_users, None),
        ("fact_bookings", "bookings", laid_out_fact, FACT_LAYOUT),
    ):
        new = newer_than(warehouse.read(f"stg_{name}"), "source_updated_at", since(table))
        keyed(table, build(new), SOURCES[name].id_column, "updated_at", partition)

    # A new version also closes the one before it, so all versions of the spaces
    # that changed are rebuilt and replaced.  The bound is what the dimension was loaded
    # through, so a load that broke off after staging is made up for by the next one.
    history = warehouse.read("stg_spaces")
    changed = newer_than(history, "source_updated_at", since("dim_spaces"))
    keyed("dim_spaces", core.versions_of_changed_spaces(history, changed), "space_id", "valid_from")

    mart = analytics.credit_utilization_l3m(
        warehouse.read("fact_bookings"), warehouse.read("dim_companies"), warehouse.read("dim_plans"), as_of
    )
    warehouse.rebuild(MART, mart, gate=gate(MART))
    warehouse.rebuild("source_report", source_report(landed, as_of))


def keep_contract(landed: Mapping[str, DataFrame]) -> None:
    broken = quality.contract(landed, SOURCES).where("NOT is_kept").collect()
    if broken:
        raise ChecksFailed("; ".join(f"contract:{r['table_name']}.{r['column_name']}" for r in broken))


def set_aside(warehouse: Warehouse, landed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The landed tables in their declared types, without the rows of which a value does not fit.

    Every table is read and typed once and kept.  What was set aside replaces
    ``rejected_values``; above the breaker's limit of any table the load stops there.
    """
    rows = {n: warehouse.stage(f"judged_{n}", judged(SOURCES[n], landed[n])) for n in landed}
    found = reduce(DataFrame.unionByName, [rejects(SOURCES[n], judged_rows) for n, judged_rows in rows.items()])
    warehouse.rebuild("rejected_values", found)
    broken = quality.reject_rates(rows).where("NOT publish").collect()
    if broken:
        raise ChecksFailed("; ".join(f"rejects:{r['table_name']}: {r['failing_rows']}" for r in broken))
    return {n: accepted(judged_rows) for n, judged_rows in rows.items()}


def source_report(landed: Mapping[str, DataFrame], as_of: date | None = None) -> DataFrame:
    """Per source its freshness, and the days on which too few rows arrived."""
    moment = datetime(as_of.year, as_of.month, as_of.day) if as_of else None
    fresh = quality.source_freshness(landed, SOURCES, moment)
    days = {n: rows.select(F.to_date(SOURCES[n].watermark).alias("day")) for n, rows in landed.items()}
    odd = quality.volume_anomaly(quality.daily_volumes(days)).where("is_anomaly")
    odd = odd.groupBy(F.col("table_name").alias("source_name")).agg(
        F.count("*").alias("odd_days"), F.max("day").alias("last_odd_day")
    )
    return fresh.join(odd, "source_name", "left").withColumn("odd_days", F.coalesce("odd_days", F.lit(0)))


def refresh_features(warehouse: Warehouse) -> DataFrame:
    """Brings the feature tables up to date unless the circuit breaker is open for what feeds them.

    Returns the breaker's report.  With too many failing rows in any source, all
    feature tables stay as they were.
    """
    sources = ("stg_bookings", "fact_bookings", "dim_spaces")
    tables = {name: warehouse.read(name) for name in sources}
    breaker = warehouse.stage("circuit_breaker", quality.circuit_breaker(tables, [c for t in sources for c in of_table(t)]))
    if breaker.where(~F.col("publish")).isEmpty():
        feature_store.refresh(warehouse, "fact_bookings", FACT_LAYOUT)
    return breaker


def export_churn(
    warehouse: Warehouse, path: str, threshold: float = 30.0, output: str = "json"
) -> DataFrame:
    """Exports the companies under the threshold and returns their number per risk level.

    ``output``: ``json`` (lines), ``json_array`` (documents of one array) or ``csv``.  An
    export replaces the one before it; nothing is written when no company is under the
    threshold.
    """
    candidates = warehouse.stage("churn_candidates", analytics.churn_candidates(warehouse.read(MART), threshold))
    if not candidates.isEmpty():
        if output == "csv":
            export_csv(candidates, path, overwrite=True)
        elif output == "json_array":
            write_json_arrays(candidates, path, overwrite=True)
        else:
            export_json(candidates, path, overwrite=True)
    return analytics.churn_summary(candidates)
