"""Order-preserving slots of a key's rows, none of which is too large for a task.

A key of at most ``LIMIT`` rows is one slot, and a plain window over the key does. Only keys of
more rows, which are counted first, are cut: windows over (key, slot) and one row per (key,
slot) replace windows over the whole key. There a slot is a stretch of the calendar as long as
every one holds at most ``LIMIT`` rows. Otherwise rows are sorted into range partitions over the
key and the whole order, stored with the number of their partition, and that is the slot: it
depends neither on days nor hours, and rows of one moment are spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.sources.storage import new_folder

#: Rows of one key in one slot, which one task sorts.
LIMIT = 1_000_000
SLOT = "_slot"


def sizes(rows: DataFrame, keys: list) -> tuple[int, int]:
    """Rows of the largest group, and of all: one partial aggregate, one row."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return tuple(n or 0 for n in counted.agg(F.max("n"), F.sum("n")).first())


def busy_keys(rows: DataFrame, key: str) -> list:
    """Keys of more rows than a task sorts: of n rows, at most n / LIMIT keys."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > LIMIT)
    return [r[0] for r in counted.select(key).toLocalIterator()]


def _is_one_of(key: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    among = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return among | F.col(key).isNull() if None in values else among


def cut(
    rows: DataFrame, keys: list[str], order_by: list[str], stretch: Column, counted: DataFrame | None = None
) -> tuple[DataFrame, Column | None]:
    """Adds ``_slot``; also tells which rows are of keys that are cut, None if no key is.

    Rows go by the first of ``keys``: where it is cut, the others are below it. ``stretch`` is the
    stretch of the calendar, which must not run against ``order_by``.  NULLs sort first, in
    slots as in ``order_by``.  ``counted`` has the key and time of every row, where that is
    cheaper to read than the rows.
    """
    key, counted = keys[0], rows if counted is None else counted
    busy = busy_keys(counted, key)
    if not busy:
        return rows.withColumn(SLOT, F.lit(None).cast("int")), None
    is_busy = _is_one_of(key, busy)
    if sizes(counted.where(is_busy), [F.col(key), stretch])[0] <= LIMIT:
        return rows.withColumn(SLOT, F.when(is_busy, stretch)), is_busy
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, 2 * -(-counted.count() // LIMIT))
    return in_ranges(rows, [*keys, *order_by], ranges), F.lit(True)


def slotted(rows: DataFrame, key: str, order_by: list[str], stretch: Column) -> DataFrame:
    """The rows of ``cut`` alone."""
    return cut(rows, [key], order_by, stretch)[0]


def in_ranges(rows: DataFrame, order_by: list[str], ranges: int) -> DataFrame:
    """The rows, stored, with the range over ``order_by`` that each lies in as ``_slot``.

    They are stored because ranges are drawn by a sample: taken twice they would differ.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(ranges, *order_by).withColumn(SLOT, F.spark_partition_id())
    folder = new_folder(spark, "ranges")
    ranged.write.mode("errorifexists").parquet(folder)
    return spark.read.schema(ranged.schema).parquet(folder)
