"""Publishing: merges over moving partitions, broken-off loads, gates and schema changes."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hotdesk.sources.warehouse import TypeChanged, Warehouse

D1, D2, D3 = date(2001, 1, 1), date(2001, 1, 2), date(2001, 1, 3)
SCHEMA = "k INT, v STRING, day DATE"
W1, W2 = datetime(2001, 1, 1, 5), datetime(2001, 1, 2, 5)


def frame(spark, rows, at=W2, schema=SCHEMA):
    """Rows of one load: all of them were loaded at the same time."""
    return spark.createDataFrame(rows, schema).withColumn("at", F.lit(str(at)).cast("timestamp_ntz"))


def rows_of(warehouse, table: str = "t") -> set:
    return {tuple(r) for r in warehouse.read(table).drop("at").collect()}


def partitions_of(spark, warehouse, table: str = "t") -> dict[str, str]:
    files = warehouse._property(table, "files")
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {warehouse.database}.{files}").collect():
        found[row["partition"].split("=")[1]] = row["partition"]
    return found


@pytest.fixture
def loaded(spark, warehouse):
    first = [(1, "a", D1), (2, "b", D1), (3, "c", D2), (4, "d", None), (5, "e", D3)]
    warehouse.rebuild_partitions("t", frame(spark, first, W1), "day", "at")
    return warehouse


def test_merge_moves_rows_between_partitions(spark, loaded):
    batch = frame(spark, [(3, "moved", D1), (4, "dated", D3), (2, "undated", None), (9, "new", date(2001, 2, 1))])
    loaded.upsert_partitions("t", batch, ["k"], "day", "at")
    assert rows_of(loaded) == {
        (1, "a", D1), (2, "undated", None), (3, "moved", D1), (4, "dated", D3), (5, "e", D3),
        (9, "new", date(2001, 2, 1)),
    }
    # 2001-01-02 lost its only row and is gone.
    assert sorted(partitions_of(spark, loaded)) == [
        "2001-01-01", "2001-01-03", "2001-02-01", "__HIVE_DEFAULT_PARTITION__",
    ]
    assert loaded.loaded_through("t") == W2


def test_merge_leaves_other_partitions_alone(spark, loaded):
    file_of = lambda k: loaded.read("t").where(F.col("k") == k).select(F.input_file_name()).first()[0]
    before = file_of(5), file_of(1)
    loaded.upsert_partitions("t", frame(spark, [(1, "z", D1)]), ["k"], "day", "at")
    assert file_of(5) == before[0] and file_of(1) != before[1]
    assert rows_of(loaded) == {(1, "z", D1), (2, "b", D1), (3, "c", D2), (4, "d", None), (5, "e", D3)}


def test_a_busy_day_is_written_by_several_tasks(spark, warehouse):
    day = F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(F.date_add(F.lit(D2), (F.col("id") % 4).cast("int")))
    rows = spark.range(0, 600_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), day.alias("day"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        warehouse.rebuild_partitions("busy", rows, "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    published = warehouse.read("busy")
    assert published.count() == 600_000
    files = {r[0] for r in published.where(F.col("day") == F.lit(D1)).select(F.input_file_name()).distinct().collect()}
    assert len(files) > 1


def test_empty_merge_changes_nothing(spark, loaded):
    before = rows_of(loaded)
    loaded.upsert_partitions("t", frame(spark, []), ["k"], "day", "at")
    assert rows_of(loaded) == before and loaded.loaded_through("t") == W1


@pytest.mark.parametrize("lazy", [True, False])
def test_a_table_may_start_empty(spark, warehouse, lazy):
    none = frame(spark, [(1, "a", D1)]).where(F.col("k") > 5) if lazy else frame(spark, [])
    warehouse.rebuild_partitions("e", none, "day", "at")
    assert warehouse.read("e").count() == 0 and warehouse.loaded_through("e") == datetime(1900, 1, 1)
    warehouse.upsert_partitions("e", frame(spark, [(1, "a", D1)]), ["k"], "day", "at")
    assert rows_of(warehouse, "e") == {(1, "a", D1)} and warehouse.loaded_through("e") == W2
    # A batch that empties the only partition of the row it moves.
    warehouse.upsert_partitions("e", frame(spark, [(1, "b", None)]), ["k"], "day", "at")
    assert rows_of(warehouse, "e") == {(1, "b", None)}


def test_a_broken_off_merge_can_be_run_again(spark, loaded, monkeypatch):
    batch = frame(spark, [(3, "moved", D1), (4, "dated", D3)])

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(loaded, "_publish", lost)
        with pytest.raises(RuntimeError):
            loaded.upsert_partitions("t", batch, ["k"], "day", "at")
    assert loaded.loaded_through("t") == W1  # so the same batch is read again
    loaded.upsert_partitions("t", batch, ["k"], "day", "at")
    assert rows_of(loaded) == {(1, "a", D1), (2, "b", D1), (3, "moved", D1), (4, "dated", D3), (5, "e", D3)}


def test_partition_filter_prunes(spark, loaded):
    plan = loaded.read("t").where(F.col("day") >= F.add_months(F.lit(date(2001, 4, 2)), -3))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    scan = [line for line in text.splitlines() if "FileScan" in line][0]
    assert "InMemoryFileIndex(2 paths)" in scan


def test_columns_come_and_go(spark, loaded):
    batch = frame(spark, [(1, D1, True)], schema="k INT, day DATE, fresh BOOLEAN")
    loaded.upsert_partitions("t", batch, ["k"], "day", "at")
    assert loaded.read("t").columns == ["k", "day", "fresh", "at"]
    assert rows_of(loaded) == {(1, D1, True), (2, D1, None), (3, D2, None), (4, None, None), (5, D3, None)}


def test_upsert_rewrites_small_tables(spark, warehouse):
    schema = "k INT, v STRING"
    warehouse.upsert("s", frame(spark, [(1, "a"), (2, "b")], W1, schema), ["k"], "at")
    warehouse.upsert("s", frame(spark, [(2, "c"), (3, "d")], W2, schema), ["k"], "at")
    assert rows_of(warehouse, "s") == {(1, "a"), (2, "c"), (3, "d")}
    assert warehouse.loaded_through("s") == W2 and warehouse.loaded_through("none") is None


def test_append_is_repeatable(spark, warehouse, monkeypatch):
    schema = "k INT, v STRING"
    warehouse.append("h", frame(spark, [(1, "a")], W1, schema), "at")
    second = frame(spark, [(1, "b"), (2, "c")], W2, schema)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "_publish", lost)
        with pytest.raises(RuntimeError):
            warehouse.append("h", second, "at")
    assert warehouse.loaded_through("h") == W1
    warehouse.append("h", second, "at")
    warehouse.append("h", frame(spark, [], W2, schema), "at")
    assert sorted(map(tuple, warehouse.read("h").drop("at").collect())) == [(1, "a"), (1, "b"), (2, "c")]
    assert warehouse.loaded_through("h") == W2
    warehouse.append("h", frame(spark, [(7, "z")], W1, schema), "at", restart=True)
    assert rows_of(warehouse, "h") == {(7, "z")}


def test_gate_keeps_the_published_table(spark, loaded):
    def refuse(rows):
        assert rows.count() > 0
        raise ValueError("refused")

    before = rows_of(loaded)
    batch = frame(spark, [(1, "z", D1)])
    for publish in (
        lambda: loaded.upsert_partitions("t", batch, ["k"], "day", "at", refuse),
        lambda: loaded.rebuild_partitions("t", batch, "day", "at", refuse),
        lambda: loaded.rebuild("t", batch, "at", refuse),
        lambda: loaded.append("t2", batch, "at", refuse),
    ):
        with pytest.raises(ValueError):
            publish()
    assert rows_of(loaded) == before and loaded.loaded_through("t") == W1
    assert not loaded.exists("t2")


def test_rebuild_while_reading_itself(spark, warehouse):
    warehouse.rebuild("r", spark.createDataFrame([(1,)], "k INT"))
    warehouse.rebuild("r", warehouse.read("r").select((F.col("k") + 1).alias("k")))
    assert rows_of(warehouse, "r") == {(2,)}


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_writes_go_to_the_shared_folder(spark):
    from hotdesk.sources.storage import new_folder

    assert spark.conf.get("spark.master").startswith("local")
    on_cluster = Session(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")
    assert new_folder(on_cluster, "x").startswith("hdfs:///shared/hotdesk/x-")
    with pytest.raises(ValueError):
        new_folder(Session(spark_master="yarn"), "x")
    assert "hotdesk-" in new_folder(Session(spark_master="local[2]"), "x")


def test_wider_columns_are_read_from_old_files(spark, warehouse):
    loads = [
        (W1, "k INT, n INT, x FLOAT, v STRING", [(1, 7, 0.5, "a")]),
        (W2, "k INT, n BIGINT, x DOUBLE, v STRING", [(2, 1 << 40, 0.1, "b")]),
        (datetime(2001, 1, 3), "k INT, n SMALLINT, x FLOAT, v STRING", [(3, 9, 0.25, "c")]),
    ]
    for at, schema, rows in loads:
        warehouse.append("t", frame(spark, rows, at, schema), "at")
    kinds = {f.name: f.dataType.simpleString() for f in warehouse.read("t").schema}
    assert (kinds["n"], kinds["x"]) == ("bigint", "double")
    assert rows_of(warehouse) == {(1, 7, 0.5, "a"), (2, 1 << 40, 0.1, "b"), (3, 9, 0.25, "c")}


@pytest.mark.parametrize("kind", ["STRING", "DOUBLE", "DATE"])
def test_other_changes_are_refused_before_a_write(spark, warehouse, tmp_path, kind):
    warehouse.append("t", frame(spark, [(1, 2)], W1, "k INT, n BIGINT"), "at")
    written = sorted(str(f) for f in (tmp_path / "warehouse" / "t").rglob("*"))
    batch = frame(spark, [(2, None)], W2, f"k INT, n {kind}")
    with pytest.raises(TypeChanged, match="n: bigint"):
        warehouse.append("t", batch, "at")
    assert sorted(str(f) for f in (tmp_path / "warehouse" / "t").rglob("*")) == written
    assert rows_of(warehouse) == {(1, 2)} and warehouse.loaded_through("t") == W1


def test_merges_widen_too(spark, warehouse):
    warehouse.rebuild_partitions("t", frame(spark, [(1, 5, D1), (2, 6, D2)], W1, "k INT, n INT, day DATE"), "day", "at")
    batch = frame(spark, [(2, 1 << 40, D3)], W2, "k BIGINT, n BIGINT, day DATE")
    warehouse.upsert_partitions("t", batch, ["k"], "day", "at")
    assert rows_of(warehouse) == {(1, 5, D1), (2, 1 << 40, D3)}
    warehouse.rebuild("u", frame(spark, [(1, 5)], W1, "k INT, n INT"))
    warehouse.upsert("u", frame(spark, [(1, 1 << 40)], W2, "k INT, n BIGINT"), ["k"])
    assert rows_of(warehouse, "u") == {(1, 1 << 40)}


def test_a_merge_of_many_partitions_is_seen_at_once(spark, warehouse, monkeypatch):
    """While a merge goes on, and when it breaks off at any statement, readers see the table before."""
    days = [date(2001, 1, 1) + timedelta(days=i) for i in range(1000)]
    first = frame(spark, [(i, "old", d) for i, d in enumerate(days)], W1)
    warehouse.rebuild_partitions("t", first, "day", "at")
    reader = warehouse.read("t").where("v = 'old'")
    seen, statements = [], spark.sql

    def counted(statement, *args, **named):
        if "ALTER TABLE" in statement or "CREATE" in statement:
            seen.append(warehouse.read("t").groupBy("v").count().collect())
        return statements(statement, *args, **named)

    monkeypatch.setattr(spark, "sql", counted)
    batch = frame(spark, [(i, "new", d) for i, d in enumerate(reversed(days))], W2)
    warehouse.upsert_partitions("t", batch, ["k"], "day", "at")
    assert len(seen) >= 4 and all([tuple(r) for r in state] == [("old", 1000)] for state in seen)
    assert [tuple(r) for r in warehouse.read("t").groupBy("v").count().collect()] == [("new", 1000)]
    assert reader.count() == 1000  # planned before the merge


def test_a_cluster_without_a_shared_catalog(spark, sf_dir, tmp_path, monkeypatch):
    """Lasting tables are refused there; a query's own warehouse is for its session alone."""
    from hotdesk.queries import QUERIES

    monkeypatch.setattr("hotdesk.sources.warehouse.one_process", lambda spark: False)
    with pytest.raises(ValueError, match="outlives the session"):
        Warehouse(spark, str(tmp_path / "lasting"), "lasting")
    for name in ("append_only", "seats_cdc_stream"):  # one that loads and one whose micro-batches do
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_many_rows_are_merged_in_shares(spark, warehouse, monkeypatch):
    from hotdesk.sources import warehouse as module

    days = [None, *(date(2001, 1, 1) + timedelta(days=i) for i in range(9))]
    first = [(i, "old", days[i % 10]) for i in range(100)] + [(None, "old", D1)]
    batch = [(i, "new", days[(i * 7 + 3) % 10]) for i in range(0, 120, 3)] + [(None, "new", None)]
    warehouse.rebuild_partitions("t", frame(spark, first, W1), "day", "at")
    written, write = [], module._write_partitioned

    def counted(rows, *rest, **more):
        written.append(rows.count())
        return write(rows, *rest, **more)

    monkeypatch.setattr(module, "MERGED_ROWS", 30)
    monkeypatch.setattr(module, "_write_partitioned", counted)
    warehouse.upsert_partitions("t", frame(spark, batch), ["k"], "day", "at")
    want = {r[0]: r for r in [*first, *batch]}
    assert len(written) > 3 and max(written) <= 30 and sum(written) == len(want)
    assert rows_of(warehouse) == set(want.values())
    assert warehouse.loaded_through("t") == W2
