"""The load of bookings as a stream: every micro-batch goes through clean, staging and fact.

The stream's own offsets say which landed files are new, so rows that come late are loaded
too; a later version of a booking wins whatever the order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hotdesk.operators.incremental import by_key
from hotdesk.plans import core, staging
from hotdesk.plans.clean import clean, every_version
from hotdesk.plans.daily import CLEAN_PARTITION, FACT_LAYOUT, LOOKUPS, gate_for
from hotdesk.schemas import SOURCES
from hotdesk.sources.storage import short_lived_shuffles
from hotdesk.sources.warehouse import Gate, Warehouse

SOURCE = SOURCES["bookings"]
KEY, VERSION = SOURCE.id_column, SOURCE.target_watermark
# Layout columns: the month of a booking, and the micro-batch that brought a staged version.
MONTH, BATCH = "_part_month", "_part_batch"


def read_landed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed bookings as a stream of Parquet files, in the declared columns."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in SOURCE.columns)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_bookings(
    landed: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    clean_layout: str | list[str] = CLEAN_PARTITION["bookings"],
    fact_layout: str | list[str] = FACT_LAYOUT,
    blocking_checks: bool = True,
) -> StreamingQuery:
    """Loads every micro-batch of landed bookings; starts with what is available.

    The lookups are read as the last daily load left them.  The layouts name partition
    columns, ``MONTH`` among them; small streams do better with months than with days.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        current = warehouse.within(batch.sparkSession)
        with short_lived_shuffles(batch.sparkSession):
            load_batch(current, batch, batch_id, clean_layout, fact_layout, blocking_checks)

    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_batch(
    warehouse: Warehouse,
    landed: DataFrame,
    batch_id: int,
    clean_layout: str | list[str] = CLEAN_PARTITION["bookings"],
    fact_layout: str | list[str] = FACT_LAYOUT,
    blocking_checks: bool = True,
) -> None:
    """One micro-batch into the three tables, each published on its own.

    Run again, after a failure at any point, it ends in the same rows: staged versions replace
    those of the same ``batch_id``, and a booking replaces a stored one only when it is later.
    Of two landed rows with one id and load time, the one of the earlier batch stays.
    """

    def gate(table: str) -> Gate | None:
        return gate_for(warehouse, table) if blocking_checks else None

    def later(table: str, version: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        month = F.floor(F.col("date_id") / 100).cast("int")
        rows = build(later_than_stored(warehouse, table, newest, version))
        return warehouse.stage(f"{table}_stream", rows.withColumn(MONTH, month))

    def merge(table: str, batch: DataFrame, version: str, layout: str | list[str]) -> None:
        warehouse.upsert_partitions(table, batch, [KEY], layout, version, gate(table))
        warehouse.unstage(f"{table}_stream")

    # One read of the files; the columns come typed, and casts of typed columns cost nothing.
    new = warehouse.stage("landed_stream", landed)
    if new.isEmpty():
        return
    # The rows are put in order once and meet the tables as they landed, before names and keys make them wide.
    newest = warehouse.stage("newest_stream", clean(SOURCE, new))
    versions = warehouse.stage("versions_stream", every_version(SOURCE, new))
    warehouse.unstage("landed_stream")

    merge("clean_bookings", later("clean_bookings", VERSION, lambda rows: rows), VERSION, clean_layout)

    named = [warehouse.read(t) for t in LOOKUPS["bookings"]]
    staged = staging.bookings(not_staged_before(warehouse, versions, batch_id), *named)
    staged, mine = staged.withColumn(BATCH, F.lit(batch_id)), (batch_id,)
    warehouse.replace_partitions("stg_bookings", staged, BATCH, [mine], gate("stg_bookings"), mine)
    warehouse.unstage("versions_stream", "staged_before_stream")

    # A version that was staged before may still be missing in the fact, if its batch broke off.
    fact = later(
        "fact_bookings", "updated_at", lambda rows: core.fact_of_current_bookings(staging.bookings(rows, *named))
    )
    warehouse.unstage("newest_stream")
    merge("fact_bookings", fact, "updated_at", fact_layout)


def later_than_stored(warehouse: Warehouse, table: str, rows: DataFrame, version: str) -> DataFrame:
    """The clean rows of which the table holds no version that is as late: keys and versions are read, no more.

    ``version`` names the load time in the table.
    """
    if not warehouse.exists(table):
        return rows
    known = warehouse.read(table).select(F.col(KEY).alias("_known"), F.col(version).alias("_known_version"))
    same = F.col(KEY).eqNullSafe(F.col("_known"))
    # A stored row without a load time is earlier than any with one.
    as_late = F.col(VERSION).isNull() | (F.col("_known_version") >= F.col(VERSION))
    return rows.join(known, same & as_late, "left_anti")


def not_staged_before(warehouse: Warehouse, versions: DataFrame, batch_id: int) -> DataFrame:
    """The versions that no earlier batch has staged.

    Equal versions have equal load times, so the history is read between the earliest and the latest
    of the batch: literals, which skip files and row groups of other times.  Keys and times alone find
    the versions that come again; as a rule there are few, and then the rows themselves are not shuffled.
    """
    if not warehouse.exists("stg_bookings"):
        return versions
    first, last = versions.agg(F.min(VERSION), F.max(VERSION)).first()
    history = warehouse.partitioned("stg_bookings").where(F.col(BATCH) != batch_id)
    near = F.col(VERSION).isNull() if first is None else (F.col(VERSION).between(first, last) | F.col(VERSION).isNull())
    key = [KEY, VERSION]
    again = by_key(versions.select(*key), history.where(near), key, "left_semi")
    return by_key(versions, warehouse.stage("staged_before_stream", again), key, "left_anti")
