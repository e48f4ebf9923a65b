"""Tables of the warehouse: Parquet folders published through the session catalog.

A table is read through a view.  Writers never touch a folder that readers use:
they write a new one, run the checks on it, and then repoint the catalog.  What a
job writes depends on how its rows can collide with loaded ones:

``rebuild``             the whole table anew (marts, dimensions, lookups);
``append``              one catalog partition per load (histories, whose keys
                        contain the load timestamp and so can never collide);
``upsert``              keyed merge that rewrites the table (small tables);
``upsert_partitions``   keyed merge that rewrites only the partitions touched;
``merge_partitions``    the same where the key decides on the partition, so that no
                        other partition is read either.

A merge, and a load that widens a column, make a new files table, whose partitions name
the old folders and the new ones, and then replace the view: readers see the table as it
was or as it is, never some partitions of each.  The files table before is kept until the
next change, for queries that were planned on it.  Where tables end with the session, the
folders that it alone names go with it; else they are left to the storage's retention rules.

Types follow the loads: a column that arrives wider is widened (old files are read as the
wider type), one that arrives narrower is cast, and any other change is refused before
anything is written.

The view also records ``loaded_through``, the watermark of the last complete load,
so that no later run scans the table for it.  It is set last, so a load that broke off is simply run again: it reads the same
batch and ends in the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from itertools import groupby
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from hotdesk.operators import incremental
from hotdesk.sources.storage import COMPRESSION, delete_folder, one_process

Gate = Callable[[DataFrame], None]
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
LOAD_ID = "_load"
# Columns of this prefix lay out the files and are not part of the table.
HIDDEN = "_part_"
# About so many rows a merge moves at a time, so that its shuffle files do not grow with the table.
MERGED_ROWS = 10_000_000
# To which types a stored type may be widened; Parquet files of the narrower one can be read as these.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


class TypeChanged(TypeError):
    """A load was refused because a column arrived in a type that the table cannot take on."""


class Warehouse:
    """The tables of one catalog database, with their files below ``root``.

    ``lasting`` tables are there for later sessions, so on a cluster they need a catalog that
    outlives this one.  Tables that are used in this session alone do with any catalog: only
    the driver looks them up, executors get paths below ``root``.
    """

    def __init__(self, spark: SparkSession, root: str, database: str, lasting: bool = True):
        if lasting and spark.conf.get("spark.sql.catalogImplementation") == "in-memory" and not one_process(spark):
            raise ValueError("tables live in the catalog: use one that outlives the session")
        self.spark, self.root, self.database, self.lasting = spark, root.rstrip("/"), database, lasting
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/catalog'")

    def within(self, spark: SparkSession) -> Warehouse:
        """The same tables for another session of the application, such as that of a micro-batch."""
        return Warehouse(spark, self.root, self.database, self.lasting)

    # ---- reading -----------------------------------------------------------

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def _property(self, table: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._name(table)}").where(F.col("key") == key).head(1)
        return rows[0]["value"] if rows else None

    def loaded_through(self, table: str) -> datetime | None:
        """Watermark of the last complete load; None when the table does not exist."""
        if not self.exists(table):
            return None
        value = self._property(table, "loaded_through")
        return datetime.fromisoformat(value) if value else incremental.EPOCH

    # ---- publishing --------------------------------------------------------

    def _new_run(self) -> str:
        return uuid4().hex[:12]

    def _folder(self, table: str, part: str) -> str:
        return f"{self.root}/{table}/{part}"

    def _publish(
        self, table: str, relation: str, columns: list[str], loaded_through: datetime | None, files: str = ""
    ) -> None:
        """Points the view of the table at a relation, in one catalog change."""
        facts, outdated = {"files": files}, None
        if self.exists(table):
            before = self._property(table, "files") or ""
            facts["files_before"] = self._property(table, "files_before") or "" if before == files else before
            outdated = None if before == files else self._property(table, "files_before")
            if loaded_through is None:
                loaded_through = self.loaded_through(table)
        if loaded_through is not None:
            facts["loaded_through"] = loaded_through.isoformat(sep=" ")
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in facts.items())
        names = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._name(table)} TBLPROPERTIES ({properties}) AS SELECT {names} FROM {relation}"
        )
        if outdated:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(outdated)}")

    def _extent(self, rows: DataFrame, watermark: str | None) -> tuple[int, datetime | None]:
        """Number of rows and their latest time, in one pass over one column."""
        latest = F.max(watermark) if watermark else F.lit(None)
        found = rows.agg(F.count("*").alias("n"), latest.alias("latest")).first()
        return found["n"], found["latest"]

    def rebuild(
        self, table: str, rows: DataFrame, watermark: str | None = None, gate: Gate | None = None
    ) -> None:
        """Replaces the whole table.  ``watermark`` names the load-time column, if it has one."""
        folder = self._folder(table, f"run={self._new_run()}")
        rows.write.mode("errorifexists").parquet(folder, compression=COMPRESSION)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        if gate:
            gate(written)
        through = self._extent(written, watermark)[1] if watermark else None
        self._publish(table, f"parquet.`{folder}`", rows.columns, through)

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: list[str],
        watermark: str | None = None,
        gate: Gate | None = None,
    ) -> None:
        """Replaces the rows whose key is in the batch and adds the batch."""
        if self.exists(table):
            stored = self.read(table)
            kinds = _merged_types(stored.schema, batch.schema)
            batch = incremental.upsert(_cast(stored, kinds), _cast(batch, kinds), keys)
        self.rebuild(table, batch, watermark, gate)

    def append(
        self,
        table: str,
        batch: DataFrame,
        watermark: str,
        gate: Gate | None = None,
        restart: bool = False,
    ) -> None:
        """Adds one load; run again after a failure, the same load replaces itself.

        ``restart`` begins a new table with this load.
        """
        before = None if restart else self.loaded_through(table)
        load = "first" if before is None else before.strftime("after_%Y%m%d_%H%M%S_%f")
        files = self._property(table, "files") if before is not None else None
        stored = self.read(files).schema if files else StructType()
        kinds = _merged_types(stored, batch.schema)
        batch = _cast(batch, kinds)
        folder = self._folder(table, f"load={self._new_run()}/{LOAD_ID}={load}")
        batch.write.mode("errorifexists").parquet(folder, compression=COMPRESSION)
        written = self.spark.read.schema(batch.schema).parquet(folder)
        count, through = self._extent(written, watermark)
        if gate and count:
            gate(written)
        if files and all(kinds.get(f.name, f.dataType) == f.dataType for f in stored):
            self._add_columns(files, batch.schema)
            # What a load that broke off has left behind.
            self.spark.sql(f"ALTER TABLE {self._name(files)} DROP IF EXISTS PARTITION ({LOAD_ID} = '{load}')")
            added = {(load,): folder} if count else {}
        else:
            added = self._folders(files, [LOAD_ID]) if files else {}
            added |= {(load,): folder} if count else {}
            schema = _with_types(stored, batch.schema, kinds, [LOAD_ID])
            files = self._create_files_table(table, schema, {LOAD_ID: "string"})
        self._add_partitions(files, [LOAD_ID], added)
        self._publish(table, self._name(files), batch.columns, through, files)

    def rebuild_partitions(
        self,
        table: str,
        rows: DataFrame,
        partition_by: str | list[str],
        watermark: str | None = None,
        gate: Gate | None = None,
        only: tuple | None = None,
    ) -> None:
        """Replaces the whole table, laid out by one or more partition columns.

        Partition columns whose name begins with ``HIDDEN`` are not shown by the table.
        ``only`` names the one partition that the rows lie in, if there is no other.
        """
        layout = _layout(partition_by)
        folder = self._folder(table, f"run={self._new_run()}")
        filled, through = _write_partitioned(rows, folder, layout, watermark, only)
        if gate:
            gate(self.spark.read.schema(rows.schema).parquet(folder))
        kinds = {c: rows.schema[c].dataType.simpleString() for c in layout}
        files = self._create_files_table(table, rows.schema, kinds)
        self._add_partitions(files, layout, {v: f"{folder}/{_path(layout, v)}" for v in filled})
        self._publish(table, self._name(files), _shown(rows), through, files)

    def upsert_partitions(
        self,
        table: str,
        batch: DataFrame,
        keys: list[str],
        partition_by: str | list[str],
        watermark: str | None = None,
        gate: Gate | None = None,
    ) -> None:
        """Keyed merge that rewrites the partitions of the batch and of the rows it replaces.

        A row whose partition value changed is removed from its old partition, and a
        partition left without rows is dropped.  Other partitions are not rewritten.
        Many rows are merged in shares, some partitions at a time.
        ``batch`` is used several times: pass a stored one.
        """
        if not self.exists(table):
            self.rebuild_partitions(table, batch, partition_by, watermark, gate)
            return
        files, layout = self._property(table, "files"), _layout(partition_by)
        target = self.read(files)
        kinds = _merged_types(target.schema, batch.schema)
        target, batch = _cast(target, kinds), _cast(batch, kinds)
        replaced = incremental.by_key(target.select(*keys, *layout), batch, keys, "left_semi")
        touched = _values(replaced.select(*layout).union(batch.select(*layout)), layout)
        if not touched:
            return
        self._release(table, files, layout)
        folder, filled, seen = self._folder(table, f"run={self._new_run()}"), [], []
        for share in _shares(target.select(*layout).union(batch.select(*layout)), layout, touched):
            within = _is_one_of(layout, share)
            kept = incremental.by_key(target.where(within), batch, keys, "left_anti")
            rows = incremental.append(kept, batch.where(within))
            written, latest = _write_partitioned(rows, folder, layout, watermark, add=bool(seen))
            filled, seen = [*filled, *written], [*seen, latest]
        through = max((t for t in seen if t is not None), default=None)
        if gate:
            gate(self.spark.read.schema(rows.schema).parquet(folder))
        # Values as they stand in paths, since those of the old partitions are read off their folders.
        gone = {_texts(v) for v in touched}
        places = {v: place for v, place in self._folders(files, layout).items() if v not in gone}
        places |= {_texts(v): f"{folder}/{_path(layout, v)}" for v in filled}
        schema = _with_types(target.schema, batch.schema, kinds, layout)
        files = self._create_files_table(
            table, schema, {c: target.schema[c].dataType.simpleString() for c in layout}
        )
        self._add_partitions(files, layout, places)
        self._publish(table, self._name(files), _shown(batch), through, files)

    def replace_partitions(
        self,
        table: str,
        rows: DataFrame,
        partition_by: str | list[str],
        values: list[tuple],
        gate: Gate | None = None,
        only: tuple | None = None,
    ) -> None:
        """Replaces the partitions with these values by the rows, all of which lie in them.

        ``only`` names the one partition that the rows lie in, if there is no other.
        """
        layout = _layout(partition_by)
        if not self.exists(table):
            self.rebuild_partitions(table, rows, layout, None, gate, only)
            return
        files = self._property(table, "files")
        stored = self.read(files).schema
        kinds = _merged_types(stored, rows.schema)
        self._release(table, files, layout)
        rows, folder = _cast(rows, kinds), self._folder(table, f"run={self._new_run()}")
        filled, _ = _write_partitioned(rows, folder, layout, None, only)
        if gate:
            gate(self.spark.read.schema(rows.schema).parquet(folder))
        gone = {_texts(v) for v in [*values, *filled]}
        places = {v: place for v, place in self._folders(files, layout).items() if v not in gone}
        places |= {_texts(v): f"{folder}/{_path(layout, v)}" for v in filled}
        schema = _with_types(stored, rows.schema, kinds, layout)
        files = self._create_files_table(table, schema, {c: stored[c].dataType.simpleString() for c in layout})
        self._add_partitions(files, layout, places)
        self._publish(table, self._name(files), _shown(rows), None, files)

    def merge_partitions(
        self,
        table: str,
        batch: DataFrame,
        partition_by: str | list[str],
        merge: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> None:
        """Replaces the partitions of the batch by ``merge(stored rows of these, batch)``.

        For tables where the key of a row alone decides on its partition: no key is looked up
        in the rest of the table.  ``batch`` is used several times: pass a stored one.
        """
        layout = _layout(partition_by)
        if not self.exists(table):
            self.rebuild_partitions(table, batch, layout)
            return
        touched = _values(batch, layout)
        if touched:
            stored = self.partitioned(table).where(_is_one_of(layout, touched))
            self.replace_partitions(table, merge(stored, batch), layout, touched)

    def partitioned(self, table: str) -> DataFrame:
        """A table that is laid out by partition columns, with the hidden ones."""
        return self.read(self._property(table, "files"))

    def partition_folders(self, table: str, partition_by: str | list[str]) -> dict[tuple, str]:
        """Which folder each partition reads; a partition that was rewritten has another one."""
        return self._folders(self._property(table, "files"), _layout(partition_by))

    # ---- catalog statements --------------------------------------------------

    def _create_files_table(self, table: str, schema: StructType, layout: dict[str, str]) -> str:
        files = f"{table}__{self._new_run()}"
        columns = {f.name: f.dataType.simpleString() for f in schema if f.name not in layout} | layout
        self.spark.sql(
            f"CREATE TABLE {self._name(files)} ({', '.join(f'`{c}` {kind}' for c, kind in columns.items())}) "
            f"USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)}) "
            f"LOCATION '{self._folder(table, files)}'"
        )
        return files

    def _add_columns(self, files: str, schema: StructType) -> None:
        known = set(self.read(files).columns)
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {self._name(files)} ADD COLUMNS ({', '.join(new)})")

    def _folders(self, files: str, layout: list[str]) -> dict[tuple, str]:
        """Partition values, as texts, and the folder that each partition reads."""
        found = {}
        for file in self.read(files).inputFiles():
            folder = unquote(file.rsplit("/", 1)[0])
            steps = folder.rsplit("/", len(layout))[1:]
            values = (unquote(step.partition("=")[2]) for step in steps)
            found[tuple(None if v == NULL_FOLDER else v for v in values)] = folder
        return found

    def _release(self, table: str, files: str, layout: list[str]) -> None:
        """Ends the files table before, as the next change begins, if the tables are for this session alone.

        The folders that it names and the present one does not are deleted.
        """
        before = self._property(table, "files_before")
        if self.lasting or not before or not self.exists(before):
            return
        gone = set(self._folders(before, layout).values()) - set(self._folders(files, layout).values())
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(before)}")
        for folder in gone:
            delete_folder(self.spark, folder)

    def _add_partitions(self, files: str, layout: list[str], places: dict[tuple, str]) -> None:
        parts = [f"PARTITION ({_equals(layout, v)}) LOCATION '{place}'" for v, place in places.items()]
        for start in range(0, len(parts), 500):
            added = " ".join(parts[start : start + 500])
            self.spark.sql(f"ALTER TABLE {self._name(files)} ADD IF NOT EXISTS {added}")
        self.spark.catalog.refreshTable(self._name(files))

    # ---- intermediate results ------------------------------------------------

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Stores intermediate rows and reads them back; the last ones of each name are kept.

        Never stage rows that are read from the stage of the same name.
        """
        folder = f"{self.root}/_stage/{name}"
        rows.write.mode("overwrite").parquet(folder, compression=COMPRESSION)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def unstage(self, *names: str) -> None:
        """Deletes intermediate rows that are read no more."""
        for name in names:
            delete_folder(self.spark, f"{self.root}/_stage/{name}")


def _merged_types(stored: StructType, batch: StructType) -> dict[str, DataType]:
    """The type of each column of the batch once it is in the table: the wider one of both."""
    known, merged, refused = {f.name: f.dataType for f in stored}, {}, []
    for field in batch:
        old, new = known.get(field.name, field.dataType), field.dataType
        names = old.simpleString(), new.simpleString()
        if old == new or names[1] in WIDER.get(names[0], ()):
            merged[field.name] = new
        elif names[0] in WIDER.get(names[1], ()):
            merged[field.name] = old
        else:
            refused.append(f"{field.name}: {names[0]} to {names[1]}")
    if refused:
        raise TypeChanged("; ".join(refused))
    return merged


def _cast(rows: DataFrame, kinds: dict[str, DataType]) -> DataFrame:
    if all(kinds.get(f.name, f.dataType) == f.dataType for f in rows.schema):
        return rows
    return rows.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in rows.columns])


def _with_types(
    stored: StructType, batch: StructType, kinds: dict[str, DataType], layout: list[str]
) -> StructType:
    """Columns of the table and then those that the batch brings, without the partition columns."""
    fields = {f.name: kinds.get(f.name, f.dataType) for f in [*stored, *batch] if f.name not in layout}
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _texts(values: tuple) -> tuple:
    return tuple(None if v is None else str(v) for v in values)


def _layout(partition_by: str | list[str]) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def _shown(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if not c.startswith(HIDDEN)]


def _write_partitioned(
    rows: DataFrame,
    folder: str,
    layout: list[str],
    watermark: str | None,
    only: tuple | None = None,
    add: bool = False,
) -> tuple[list[tuple], datetime | None]:
    """Writes one folder per combination of partition values.

    Busy values are split over several tasks, quiet ones share a task.  Rows of ``only`` one
    partition are written as they lie, neither dealt out nor sorted.  Returns the partition
    values and the latest load time, both seen while writing.
    """
    seen = Observation()
    latest = F.max(watermark) if watermark else F.max(F.lit(None).cast("timestamp_ntz"))
    balanced = rows.drop(*layout) if only else rows.hint("rebalance", *[F.col(c) for c in layout])
    filled = F.count("*") if only else F.collect_set(F.struct(*layout))
    observed = balanced.observe(seen, filled.alias("filled"), latest.cast("string").alias("latest"))
    writer = observed.write.mode("append" if add else "errorifexists").option("compression", COMPRESSION)
    if only:
        writer.parquet(f"{folder}/{_path(layout, only)}")
    else:
        writer.partitionBy(*layout).parquet(folder)
    found = seen.get
    values = [only] * min(found["filled"], 1) if only else [tuple(v) for v in found["filled"]]
    return values, datetime.fromisoformat(found["latest"]) if found["latest"] else None


def _values(rows: DataFrame, layout: list[str]) -> list[tuple]:
    """Distinct partition values: one per day or month of data, never one per row."""
    return [tuple(r) for r in rows.select(*layout).distinct().toLocalIterator()]


def _shares(rows: DataFrame, layout: list[str], values: list[tuple]) -> list[list[tuple]]:
    """The partitions in lots of about ``MERGED_ROWS`` rows; those below one first value stay together."""
    count = dict(tuple(r) for r in rows.groupBy(layout[0]).count().toLocalIterator())
    shares: list[list[tuple]] = []
    size = 0
    in_order = sorted(values, key=lambda v: (v[0] is None, v[0] if v[0] is not None else 0))
    for first, some in groupby(in_order, key=lambda v: v[0]):
        size += count.get(first, 0)
        if not shares or size > MERGED_ROWS:
            shares, size = [*shares, []], count.get(first, 0)
        shares[-1].extend(some)
    return shares


def _is_one_of(layout: list[str], values: list[tuple]) -> Column:
    """Whether a row lies below one of these partitions; below its first value, where that is known."""
    first = F.col(layout[0])
    known = sorted({v[0] for v in values if v[0] is not None})
    among = first.isin(known) if known else F.lit(False)
    unknown = [v[1:] for v in values if v[0] is None]
    if not unknown:
        return among
    below = _is_one_of(layout[1:], unknown) if len(layout) > 1 else F.lit(True)
    return among | (first.isNull() & below)


def _path(layout: list[str], value: tuple) -> str:
    return "/".join(f"{c}={NULL_FOLDER if v is None else v}" for c, v in zip(layout, value, strict=True))


def _equals(layout: list[str], value: tuple) -> str:
    return ", ".join(f"`{c}` = " + ("NULL" if v is None else f"'{v}'") for c, v in zip(layout, value, strict=True))
