"""Registered queries: one per operator and data product, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from hotdesk.functions import business as rules
from hotdesk.functions.keys import surrogate_key
from hotdesk.functions.masking import mask_email, mask_phone
from hotdesk.operators import incremental, quality
from hotdesk.operators.dates import month_of
from hotdesk.operators.history import with_next
from hotdesk.operators.lookups import lookup_join
from hotdesk.operators.quality import REJECTS
from hotdesk.plans import analytics, checks, core, feature_store, features, staging
from hotdesk.plans.clean import clean, judged, typed
from hotdesk.plans import daily
from hotdesk.plans.daily import FACT_LAYOUT, FACT_PARTITION, MART, laid_out_fact
from hotdesk.schemas import SOURCES
from hotdesk.sources import files, landing
from hotdesk.sources.storage import COMPRESSION, new_folder, short_lived_shuffles
from hotdesk.sources.warehouse import Warehouse
from hotdesk.streaming import bookings, seats

Query = Callable[[SparkSession, str], DataFrame]

# Run parameters of the registered queries.
AS_OF = date(2001, 8, 1)
EARLIER = date(2001, 6, 1)
FIRST_SPLIT = datetime(1997, 6, 1)
SPLIT = datetime(2000, 1, 1)
LATE_FROM = date(1999, 3, 1)
CHURN_THRESHOLD = 30.0


class Layers:
    """The layers over one data folder, each built on demand as a lazy DataFrame.

    Products that show no lookup's names are built over ``slim_fact``: without lookup joins,
    with one window, reading only the columns that they use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of ``build``, written once to the shared folder and read back."""
        if name not in self._stored:
            rows, folder = build(), new_folder(self.spark, name)
            rows.write.mode("errorifexists").parquet(folder)
            self._stored[name] = self.spark.read.schema(rows.schema).parquet(folder)
        return self._stored[name]

    def raw(self, name: str) -> DataFrame:
        return landing.landed(self.spark, self.sf_dir, name)

    def clean(self, name: str) -> DataFrame:
        return clean(SOURCES[name], self.raw(name))

    def lookup(self, name: str) -> DataFrame:
        return self.clean(name)

    def stg(self, name: str) -> DataFrame:
        if name == "bookings":
            return staging.bookings(self.clean(name), self.lookup("status"), self.lookup("booking_types"))
        if name == "spaces":
            return self.spaces()
        return getattr(staging, name)(self.clean(name))

    def spaces(self) -> DataFrame:
        """All landed versions, staged (the history that accumulates over loads)."""
        return staging.spaces(typed(SOURCES["spaces"], self.raw("spaces")), self.lookup("office_groups"))

    def fact(self) -> DataFrame:
        return core.fact_bookings(self.stg("bookings"))

    def slim_fact(self) -> DataFrame:
        """The fact without names; an order is landed once, so no booking has two rows of one load time."""
        bookings = clean(SOURCES["bookings"], self.raw("bookings"), distinct_times=True)
        return core.fact_of_current_bookings(staging.bookings(bookings))

    def dim(self, name: str) -> DataFrame:
        return getattr(core, f"dim_{name}")(self.stg(name))

    def space_history(self) -> DataFrame:
        """The versions of the spaces, stored: they are counted and then read again."""
        staged = self.stored("stg_spaces", self.spaces)
        return self.stored("dim_spaces", lambda: core.dim_spaces(staged))

    def changes(self) -> DataFrame:
        """Several staged versions per booking."""
        rows = typed(SOURCES["bookings"], landing.booking_changes(self.spark, self.sf_dir))
        return staging.bookings(rows, self.lookup("status"), self.lookup("booking_types"))

    def credits(self) -> DataFrame:
        return analytics.credits_by_company_plan(self.slim_fact(), self.dim("companies"), self.dim("plans"), AS_OF)

    def rates(self) -> DataFrame:
        """Utilisation rates, stored: the network mean is compared with every one of them."""
        return self.stored("rates", lambda: analytics.utilization(self.credits()))

    def mart(self) -> DataFrame:
        return analytics.credit_utilization_l3m(self.slim_fact(), self.dim("companies"), self.dim("plans"), AS_OF)

    def churn(self) -> DataFrame:
        return analytics.churn_candidates(self.mart(), CHURN_THRESHOLD)

    def model(self, table: str) -> DataFrame:
        layer, name = table.split("_", 1)
        if layer == "fact":
            return self.fact()
        return {"clean": self.clean, "stg": self.stg, "dim": self.dim}[layer](name)

    def warehouse(self) -> Warehouse:
        """An empty warehouse in a fresh part of the shared folder, for this session alone."""
        folder, database = new_folder(self.spark, "warehouse"), f"hotdesk_{uuid4().hex[:12]}"
        return Warehouse(self.spark, folder, database, lasting=False)


class StoredLayers(Layers):
    """The layers as the declared checks read them: what is read again is computed once and stored.

    Clean tables, landed spaces and their history are stored whole. Staging is a projection of a clean
    table, made as it is read. The fact and the dimensions, which no other table is made of, are
    stored with the columns that are checked.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, declared: list[quality.Check]):
        super().__init__(spark, sf_dir)
        self.declared = declared

    def raw(self, name: str) -> DataFrame:
        """The spaces, which clean and staging both read, are derived from the lines once."""
        rows = lambda: Layers.raw(self, name)
        return self.stored("raw_spaces", rows) if name == "spaces" else rows()

    def clean(self, name: str) -> DataFrame:
        return self.stored(f"clean_{name}", lambda: Layers.clean(self, name))

    def spaces(self) -> DataFrame:
        return self.stored("stg_spaces", lambda: Layers.spaces(self))

    def fact(self) -> DataFrame:
        return self.stored("fact_bookings", lambda: self._checked("fact_bookings", Layers.fact(self)))

    def dim(self, name: str) -> DataFrame:
        return self.stored(f"dim_{name}", lambda: self._checked(f"dim_{name}", Layers.dim(self, name)))

    def _checked(self, table: str, rows: DataFrame) -> DataFrame:
        """The columns that checks of the table name, or of its children."""
        checks = [c for c in self.declared if c.table == table]
        if any(c.condition for c in checks):
            return rows
        names = {c.column for c in checks} | {c.parent[1] for c in self.declared if c.parent and c.parent[0] == table}
        return rows.select(*[c for c in rows.columns if c in names])

    def models(self) -> dict[str, DataFrame]:
        names = {c.table for c in self.declared} | {c.parent[0] for c in self.declared if c.parent}
        return {name: self.model(name) for name in sorted(names)}


def _before(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column) < incremental.timestamp_literal(SPLIT))


def _after(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column) >= incremental.timestamp_literal(SPLIT))


# ---- sources and columns -----------------------------------------------------


def scan_sources(at: Layers) -> DataFrame:
    counts = [
        at.raw(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source_name"), "row_count")
        for name in SOURCES
    ]
    return reduce(DataFrame.unionByName, counts)


def typed_projection(at: Layers) -> DataFrame:
    """Bookings landed as text and typed again, column by column."""
    raw = at.raw("bookings")
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return typed(SOURCES["bookings"], as_text)


def typed_with_rejects(at: Layers) -> DataFrame:
    """Bookings landed as text, some of them spoilt, typed in one pass that keeps what cannot be."""
    raw, key = at.raw("bookings"), F.col("booking_id")
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    spoilt = as_text.withColumns(
        {
            "status_id": F.when(key % 50 == 0, "n/a").otherwise(F.col("status_id")),
            "credits": F.when(key % 70 == 0, F.concat("credits", F.lit("x"))).otherwise(F.col("credits")),
            "booking_id": F.when(key % 110 == 0, F.lit(None)).otherwise(key),
        }
    )
    set_aside = F.transform(REJECTS, lambda r: F.concat_ws(":", r["column_name"], r["value"], r["reason"]))
    return judged(SOURCES["bookings"], spoilt).select(
        "booking_id", "status_id", "credits", "check_in_datetime", F.concat_ws(",", set_aside).alias("rejects")
    )


def surrogate_keys(at: Layers) -> DataFrame:
    return at.raw("bookings").select(
        "booking_id",
        surrogate_key("booking_id").alias("one_part"),
        surrogate_key("booking_id", "updated_at").alias("two_parts"),
        surrogate_key("booking_id", "check_in_datetime").alias("nullable_part"),
    )


def read_json_array(at: Layers) -> DataFrame:
    mart, path = at.stored(MART, at.mart), new_folder(at.spark, "json-array")
    files.write_json_arrays(mart, path, rows_per_file=500)
    return files.read_json_array(at.spark, path, mart.schema)


# ---- utilisation -------------------------------------------------------------


def revenue_brl(at: Layers) -> DataFrame:
    cents = F.col("credits_in_money")
    return at.raw("bookings").select("booking_id", cents, rules.revenue_brl(cents).alias("revenue_brl"))


def round_money(at: Layers) -> DataFrame:
    return at.raw("bookings").select(
        "booking_id", rules.round_money(F.col("credits_in_money") / 300).alias("third_of_amount")
    )


def duration_minutes(at: Layers) -> DataFrame:
    start, end = F.col("check_in_datetime"), F.col("check_out_datetime")
    return at.raw("bookings").select(
        "booking_id",
        rules.duration_minutes(start, end).alias("duration_minutes"),
        rules.duration_minutes(end, start).alias("reversed_minutes"),
    )


def booking_status(at: Layers) -> DataFrame:
    inputs = ["is_cancelled", "is_no_show", "is_future", "check_in_datetime", "check_out_datetime"]
    status = rules.booking_status(*[F.col(c) for c in inputs])
    return at.raw("bookings").select("booking_id", status.alias("booking_status_derived"))


def rolling_3m_filter(at: Layers) -> DataFrame:
    return analytics.recent_bookings(at.slim_fact(), AS_OF).select("booking_id", "check_in_date")


def star_join(at: Layers) -> DataFrame:
    joined = analytics.star_join(
        at.slim_fact().select("booking_id", "company_id", "plan_id", "credits_used"),
        at.dim("companies").select("company_id", "company_name", "company_size_tier"),
        at.dim("plans").select("plan_id", "plan_name", "plan_type"),
    )
    return joined.drop("company_id", "plan_id")


def safe_ratio(at: Layers) -> DataFrame:
    return at.rates().select("company_id", "plan_name", analytics.CEILING, analytics.RATE)


def network_average(at: Layers) -> DataFrame:
    return analytics.network_average(at.rates()).select(rules.rounded(F.col("network_mean")).alias("media_geral_rede_perc"))


def scalar_cross_join(at: Layers) -> DataFrame:
    return analytics.with_network_average(at.rates()).select(
        "company_id", "plan_name", analytics.RATE, rules.rounded(F.col("network_mean")).alias("media_geral_rede_perc")
    )


def delta_vs_mean(at: Layers) -> DataFrame:
    return analytics.compared(at.rates()).select("company_id", "plan_name", analytics.RATE, "delta_vs_media")


def engagement_status(at: Layers) -> DataFrame:
    return (
        analytics.compared(at.rates())
        .groupBy("status_de_engajamento")
        .agg(
            F.count("*").alias("companies"),
            F.count(analytics.RATE).alias("with_known_rate"),
            F.max(analytics.RATE).alias("highest_rate"),
        )
    )


def utilization_sorted(at: Layers) -> DataFrame:
    return analytics.least_used_first(at.rates()).select("company_id", "plan_name", analytics.RATE)


# ---- staging columns ---------------------------------------------------------


def left_lookup_status(at: Layers) -> DataFrame:
    named = lookup_join(
        at.clean("bookings"), at.lookup("status"), "status_id", "status_id", {"status_name": "status_name"}
    )
    return named.select("booking_id", "status_id", "status_name")


def left_lookup_types(at: Layers) -> DataFrame:
    named = lookup_join(
        at.clean("bookings"),
        at.lookup("booking_types"),
        "booking_type_id",
        "booking_type_id",
        {"type_name": "booking_type_name"},
    )
    return named.select("booking_id", "booking_type_id", "booking_type_name")


def left_lookup_groups(at: Layers) -> DataFrame:
    named = lookup_join(
        at.clean("spaces"), at.lookup("office_groups"), "space_id", "group_id", {"group_name": "office_group_name"}
    )
    return named.select("space_id", "office_group_name")


def company_size_tier(at: Layers) -> DataFrame:
    return at.raw("companies").select(
        "company_id", "employee_count", rules.company_size_tier(F.col("employee_count")).alias("company_size_tier")
    )


def cost_per_credit(at: Layers) -> DataFrame:
    cost = rules.cost_per_credit(F.col("plan_value"), F.col("monthly_credits"))
    return at.raw("plans").select("plan_id", "monthly_credits", "plan_value", cost.alias("cost_per_credit"))


def occupancy_rate(at: Layers) -> DataFrame:
    rate = rules.occupancy_rate_pct(F.col("total_seats"), F.col("available_seats"))
    return at.raw("spaces").select("space_id", "updated_at", rate.alias("occupancy_rate_pct"))


def masked_email(at: Layers) -> DataFrame:
    return at.raw("users").select("user_id", mask_email(F.col("email")).alias("email_masked"))


def masked_phone(at: Layers) -> DataFrame:
    return at.raw("users").select("user_id", mask_phone(F.col("phone")).alias("phone_masked"))


# ---- history -----------------------------------------------------------------


def scd2_lead(at: Layers) -> DataFrame:
    return with_next(at.raw("spaces").select("space_id", "updated_at"), "space_id", "updated_at", "next_updated_at")


def current_spaces(at: Layers) -> DataFrame:
    return at.dim("spaces").where("is_current_version").select("space_dw_sk", "space_id", "tier", "valid_from")


def dim_spaces(at: Layers) -> DataFrame:
    """Two loads: the second one closes the versions that the first left open."""
    warehouse = at.warehouse()
    history = warehouse.stage("history", at.spaces())
    first = _before(history, "source_updated_at")
    warehouse.rebuild("dim_spaces", core.dim_spaces(first))
    changed = _after(history, "source_updated_at")
    versions = warehouse.stage("versions", core.versions_of_changed_spaces(history, changed))
    warehouse.upsert("dim_spaces", versions, ["space_id"])
    return warehouse.read("dim_spaces")


def daily_dim_spaces(at: Layers) -> DataFrame:
    """The dimension as the daily load builds it: two loads, the second with all landed spaces.

    What the dimension is not built from lands nothing.
    """
    warehouse, landed = at.warehouse(), landing.all_landed(at.spark, at.sf_dir)
    landed = {n: rows if n in ("spaces", "office_groups") else rows.where("false") for n, rows in landed.items()}
    first = {**landed, "spaces": _before(landed["spaces"], SOURCES["spaces"].watermark)}
    for rows in (first, landed):
        daily.run(warehouse, rows, AS_OF, blocking_checks=False)
    return warehouse.read("dim_spaces")


def point_in_time_join(at: Layers) -> DataFrame:
    return features.booking_at_the_time(at.slim_fact(), at.space_history())


# ---- churn -------------------------------------------------------------------


def churn_summary(at: Layers) -> DataFrame:
    return analytics.churn_summary(at.churn())


def export_json_roundtrip(at: Layers) -> DataFrame:
    candidates, path = at.churn(), new_folder(at.spark, "json")
    files.export_json(candidates, path)
    return files.read_json_lines(at.spark, path, candidates.schema)


def export_csv_roundtrip(at: Layers) -> DataFrame:
    candidates, path = at.stored("churn", at.churn), new_folder(at.spark, "csv")
    return files.read_csv(at.spark, path, candidates.schema) if files.export_csv(candidates, path) else candidates


# ---- loads -------------------------------------------------------------------


def latest_per_key(at: Layers) -> DataFrame:
    lines = landing.table(at.spark, at.sf_dir, "lineitem")
    return incremental.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def incremental_filter(at: Layers) -> DataFrame:
    raw = at.raw("bookings")
    target = clean(SOURCES["bookings"], _before(raw, "updated_at"))
    loaded = incremental.high_watermark(target, "source_updated_at")
    return incremental.newer_than(raw, "updated_at", loaded).select("booking_id", "updated_at")


def upsert_merge(at: Layers) -> DataFrame:
    """Two loads of booking changes into a fact laid out by month of check-in.

    The second load moves most of the bookings that it updates to another month.
    """
    warehouse, month = at.warehouse(), "check_in_month"

    def fact(staged: DataFrame) -> DataFrame:
        return core.fact_bookings(staged).withColumn(month, month_of(F.col(FACT_PARTITION)))

    staged = warehouse.stage("changes", at.changes())
    warehouse.rebuild_partitions("fact_bookings", fact(_before(staged, "source_updated_at")), month)
    batch = warehouse.stage("batch", fact(_after(staged, "source_updated_at")))
    warehouse.upsert_partitions("fact_bookings", batch, ["booking_id"], month)
    return warehouse.read("fact_bookings")


def append_only(at: Layers) -> DataFrame:
    """Two loads of a history table."""
    warehouse = at.warehouse()
    history = warehouse.stage("history", at.spaces())
    warehouse.append("stg_spaces", _before(history, "source_updated_at"), "source_updated_at")
    warehouse.append("stg_spaces", _after(history, "source_updated_at"), "source_updated_at")
    return warehouse.read("stg_spaces")


def schema_sync(at: Layers) -> DataFrame:
    """Two appends to a stored table: it has a column the batch lost and lacks one the batch gained."""
    rows = typed(SOURCES["bookings"], at.raw("bookings")).select(
        "booking_id", "credits", "app_type", "source_updated_at"
    )
    target = _before(rows, "source_updated_at").drop("app_type").withColumn("channel", F.lit("old"))
    warehouse = at.warehouse()
    warehouse.append("synced", target, "source_updated_at")
    warehouse.append("synced", _after(rows, "source_updated_at"), "source_updated_at")
    return warehouse.read("synced")


def schema_sync_types(at: Layers) -> DataFrame:
    """Three appends: the second brings two wider columns, the third narrower ones again."""
    rows = typed(SOURCES["bookings"], at.raw("bookings")).select(
        "booking_id", "status_id", "credits", "source_updated_at"
    )
    since, until = incremental.timestamp_literal(FIRST_SPLIT), incremental.timestamp_literal(SPLIT)
    moment, narrow = F.col("source_updated_at"), {"status_id": F.col("status_id").cast("int")}
    warehouse = at.warehouse()
    for load, columns in (
        (rows.where(moment < since), {**narrow, "credits": F.col("credits").cast("float")}),
        (rows.where((moment >= since) & (moment < until)), {}),
        (rows.where(moment >= until), narrow),
    ):
        warehouse.append("widened", load.withColumns(columns) if columns else load, "source_updated_at")
    return warehouse.read("widened")


def mat_full_rebuild(at: Layers) -> DataFrame:
    """The mart of a month earlier, replaced as a whole by the mart of the day."""
    warehouse = at.warehouse()
    inputs = (at.slim_fact(), at.dim("companies"), at.dim("plans"))
    warehouse.rebuild(MART, analytics.credit_utilization_l3m(*inputs, EARLIER))
    warehouse.rebuild(MART, analytics.credit_utilization_l3m(*inputs, AS_OF))
    return warehouse.read(MART)


def partition_pruned_scan(at: Layers) -> DataFrame:
    """Daily totals of the window, read from the fact laid out by check-in date."""
    warehouse = at.warehouse()
    warehouse.rebuild_partitions("fact_bookings", laid_out_fact(at.stg("bookings")), FACT_LAYOUT)
    return (
        analytics.recent_bookings(warehouse.read("fact_bookings"), AS_OF)
        .groupBy("check_in_date")
        .agg(F.count("*").alias("bookings"), F.sum("credits_used").alias("credits_used"))
    )


# ---- quality -----------------------------------------------------------------


def check_report(at: Layers, *kinds: str) -> DataFrame:
    declared = checks.of_kind(*kinds) if kinds else list(checks.CHECKS)
    return quality.report(StoredLayers(at.spark, at.sf_dir, declared).models(), declared)


def dq_no_checkin_on_cancelled(at: Layers) -> DataFrame:
    rule = checks.of_kind("row_rule")[0]
    return at.stg("bookings").where(rule.row_fails()).select(
        "booking_id", "is_cancelled", "is_no_show", "check_in_datetime"
    )


def source_freshness(at: Layers) -> DataFrame:
    landed = landing.all_landed(at.spark, at.sf_dir)
    return quality.source_freshness(landed, SOURCES, datetime(AS_OF.year, AS_OF.month, AS_OF.day))


def dq_volume_anomaly(at: Layers) -> DataFrame:
    days = {name: at.raw(name).select(F.to_date(SOURCES[name].watermark).alias("day")) for name in SOURCES}
    return quality.volume_anomaly(quality.daily_volumes(days))


def dq_circuit_breaker(at: Layers) -> DataFrame:
    declared = checks.of_kind(*quality.ROW_KINDS)
    return quality.circuit_breaker(StoredLayers(at.spark, at.sf_dir, declared).models(), declared)


def dq_contract(at: Layers) -> DataFrame:
    return quality.contract(landing.all_landed(at.spark, at.sf_dir), SOURCES)


# ---- features and streams ----------------------------------------------------


def seats_cdc_latest(at: Layers) -> DataFrame:
    return seats.latest_seats(seats.seat_changes(landing.table(at.spark, at.sf_dir, "lineitem")))


def seats_cdc_stream(at: Layers) -> DataFrame:
    """The same result kept current by a stream that reads all change files."""
    warehouse = at.warehouse()
    schema = landing.table(at.spark, at.sf_dir, "lineitem").schema
    changes = seats.read_changes(at.spark, at.sf_dir, "lineitem.parquet", schema)
    checkpoint = new_folder(at.spark, "stream")
    seats.keep_seats_current(changes, warehouse, "seats", checkpoint).awaitTermination()
    return warehouse.read("seats")


def bookings_stream(at: Layers) -> DataFrame:
    """The fact as a stream leaves it that reads all versions of all bookings, a third per micro-batch."""
    warehouse, folder = at.warehouse(), new_folder(at.spark, "landed")
    for name in daily.LOOKUPS["bookings"]:
        warehouse.rebuild(name, at.lookup(name.removeprefix("clean_")))
    with short_lived_shuffles(at.spark):
        changes = landing.booking_changes(at.spark, at.sf_dir).repartition(3, "updated_at")
        changes.write.parquet(folder, compression=COMPRESSION)
    landed = bookings.read_landed(at.spark, folder, files_per_batch=1)
    bookings.stream_bookings(
        landed, warehouse, new_folder(at.spark, "stream"), bookings.MONTH, bookings.MONTH, blocking_checks=False
    ).awaitTermination()
    return warehouse.read("fact_bookings")


def features_after_two_loads(at: Layers) -> Warehouse:
    """Feature tables after two loads: the second merges bookings and spaces, and only months
    that it touches, or that follow them, are made anew."""
    warehouse, month = at.warehouse(), "check_in_month"
    fact = warehouse.stage("fact", at.slim_fact().withColumn(month, month_of(F.col(FACT_PARTITION))))
    history = warehouse.stage("history", at.spaces())
    late = (F.col("booking_id") % 40 == 0) & (F.col(FACT_PARTITION) >= LATE_FROM)
    late = F.coalesce(late, F.lit(False))  # come with the second load, whatever their own time
    second = fact.where((F.col("updated_at") >= incremental.timestamp_literal(SPLIT)) | late)
    warehouse.rebuild_partitions(
        "fact_bookings", fact.where(F.col("updated_at") < incremental.timestamp_literal(SPLIT)).where(~late), month
    )
    warehouse.rebuild("dim_spaces", core.dim_spaces(_before(history, "source_updated_at")))
    feature_store.refresh(warehouse, "fact_bookings", [month])
    warehouse.upsert_partitions("fact_bookings", second, ["booking_id"], month)
    warehouse.rebuild("dim_spaces", core.dim_spaces(history))
    feature_store.refresh(warehouse, "fact_bookings", [month])
    return warehouse


_PLANS: dict[str, Callable[[Layers], DataFrame]] = {
    "scan_sources": scan_sources,
    "typed_projection": typed_projection,
    "typed_with_rejects": typed_with_rejects,
    "surrogate_key": surrogate_keys,
    "read_json_array": read_json_array,
    "revenue_brl": revenue_brl,
    "duration_minutes": duration_minutes,
    "booking_status": booking_status,
    "rolling_3m_filter": rolling_3m_filter,
    "star_join": star_join,
    "credits_by_company_plan": Layers.credits,
    "safe_ratio": safe_ratio,
    "round_money": round_money,
    "network_average": network_average,
    "scalar_cross_join": scalar_cross_join,
    "delta_vs_mean": delta_vs_mean,
    "engagement_status": engagement_status,
    "utilization_sorted": utilization_sorted,
    "credit_utilization_l3m": Layers.mart,
    **{f"clean_{name}": (lambda at, name=name: at.clean(name)) for name in SOURCES},
    "left_lookup_status": left_lookup_status,
    "left_lookup_types": left_lookup_types,
    "left_lookup_groups": left_lookup_groups,
    "company_size_tier": company_size_tier,
    "cost_per_credit": cost_per_credit,
    "occupancy_rate": occupancy_rate,
    "mask_email": masked_email,
    "mask_phone": masked_phone,
    **{f"stg_{name}": (lambda at, name=name: at.model(f"stg_{name}")) for name in SOURCES},
    "fact_bookings": Layers.fact,
    "dim_companies": lambda at: at.dim("companies"),
    "dim_plans": lambda at: at.dim("plans"),
    "dim_users": lambda at: at.dim("users"),
    "scd2_lead": scd2_lead,
    "current_spaces": current_spaces,
    "dim_spaces": dim_spaces,
    "daily_dim_spaces": daily_dim_spaces,
    "point_in_time_join": point_in_time_join,
    "churn_candidates": Layers.churn,
    "churn_summary": churn_summary,
    "export_json_roundtrip": export_json_roundtrip,
    "export_csv_roundtrip": export_csv_roundtrip,
    "latest_per_key": latest_per_key,
    "incremental_filter": incremental_filter,
    "upsert_merge": upsert_merge,
    "append_only": append_only,
    "schema_sync": schema_sync,
    "schema_sync_types": schema_sync_types,
    "mat_full_rebuild": mat_full_rebuild,
    "partition_pruned_scan": partition_pruned_scan,
    "dq_unique": lambda at: check_report(at, "unique"),
    "dq_not_null": lambda at: check_report(at, "not_null"),
    "dq_accepted_values": lambda at: check_report(at, "accepted_values"),
    "dq_relationships": lambda at: check_report(at, "relationships"),
    "dq_between": lambda at: check_report(at, "between"),
    "dq_column_type": lambda at: check_report(at, "column_type"),
    "dq_no_checkin_on_cancelled": dq_no_checkin_on_cancelled,
    "dq_report": check_report,
    "source_freshness": source_freshness,
    "space_performance_monthly": lambda at: analytics.space_performance_monthly(at.slim_fact(), at.space_history()),
    "user_behavior_features": lambda at: features.user_behavior_features(at.slim_fact()),
    "wide_booking_features": lambda at: features.wide_booking_features(at.slim_fact(), at.space_history()),
    "user_profile_features": lambda at: features.user_profile_features(at.slim_fact(), at.space_history()),
    "features_two_loads": lambda at: features_after_two_loads(at).read("wide_booking_features"),
    "profiles_two_loads": lambda at: features_after_two_loads(at).read("user_profile_features"),
    "space_months_two_loads": lambda at: features_after_two_loads(at).read("space_performance_monthly"),
    "dim_date": lambda at: features.dim_date(at.slim_fact()),
    "dq_volume_anomaly": dq_volume_anomaly,
    "dq_circuit_breaker": dq_circuit_breaker,
    "dq_contract": dq_contract,
    "seats_cdc_latest": seats_cdc_latest,
    "seats_cdc_stream": seats_cdc_stream,
    "bookings_stream": bookings_stream,
}


def _registered(plan: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Layers(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _registered(plan) for name, plan in _PLANS.items()}
