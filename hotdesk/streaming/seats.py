"""Near-real-time seats: the latest ``available_seats`` per space from a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hotdesk.operators.incremental import append, latest_per_key
from hotdesk.sources.warehouse import Warehouse

# Order of changes: by time, then by the feed's own position.
CHANGE_ORDER = ["changed_at", "change_id", "change_line", "available_seats"]
BUCKET = "_part_space"


def seat_changes(feed: DataFrame) -> DataFrame:
    """Change rows from shipped lines: one change of seats per line."""
    return feed.select(
        F.col("l_suppkey").alias("space_id"),
        F.col("l_quantity").cast("int").alias("available_seats"),
        F.col("l_shipdate").alias("changed_at"),
        F.col("l_orderkey").alias("change_id"),
        F.col("l_linenumber").alias("change_line"),
    )


def latest_seats(changes: DataFrame) -> DataFrame:
    return latest_per_key(changes, ["space_id"], CHANGE_ORDER)


def read_changes(spark: SparkSession, folder: str, file_name: str, schema: StructType) -> DataFrame:
    feed = spark.readStream.schema(schema).option("pathGlobFilter", file_name).parquet(folder)
    return seat_changes(feed)


def newest_by_space(changes: DataFrame) -> DataFrame:
    """One row per space, its latest change: an aggregate, so a stream keeps it as state per space."""
    newest = changes.groupBy("space_id").agg(F.max(F.struct(*CHANGE_ORDER)).alias("newest"))
    return newest.select("space_id", *[F.col(f"newest.{c}").alias(c) for c in CHANGE_ORDER])


def keep_seats_current(
    changes: DataFrame, warehouse: Warehouse, table: str, checkpoint: str, buckets: int = 64
) -> StreamingQuery:
    """Keeps the seats table current; starts with what is available.

    The latest change per space is streaming state, one row per space.  A micro-batch reads its own
    changes and hands on the spaces whose seats they changed; those are merged into their
    buckets of the table, and no other bucket is read or written.  The later change wins
    against the stored row too, so a batch that is run again, rows that come late and a
    stream that lost its state leave the table right.
    """
    bucket = F.pmod(F.xxhash64("space_id"), F.lit(buckets)).cast("int")

    def newest(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return latest_per_key(append(stored, batch), ["space_id", BUCKET], CHANGE_ORDER, unique_order=True)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        current = warehouse.within(batch.sparkSession)
        changed = current.stage(f"{table}_changed", batch.withColumn(BUCKET, bucket))
        current.merge_partitions(table, changed, BUCKET, newest)

    return (
        newest_by_space(changes)
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
