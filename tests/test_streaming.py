"""The seats stream: files that arrive one by one, late ones too, end in the batch result."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta
from pathlib import Path
from uuid import uuid4

from pyspark.sql import functions as F

from hotdesk.plans import core, staging
from hotdesk.plans.clean import clean
from hotdesk.schemas import SOURCES
from hotdesk.sources import landing
from hotdesk.sources.storage import SHUFFLE_CLEANUP, short_lived_shuffles
from hotdesk.sources.warehouse import Warehouse
from hotdesk.streaming import bookings, seats

SCHEMA = "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"


def test_stream_equals_batch_in_any_order_of_arrival(spark, warehouse, tmp_path):
    rng = random.Random(11)
    changes = [
        (i, 0 if i % 3 == 0 else rng.randrange(1, 8), i % 4, float(rng.randrange(50)),
         datetime(2001, 1, 1) + timedelta(hours=rng.randrange(200)))
        for i in range(120)
    ]
    folder = tmp_path / "feed"
    feed = spark.createDataFrame(changes, SCHEMA)
    for part in (2, 0, 1):  # the newest changes arrive first
        piece = sorted(changes, key=lambda c: c[4])[part * 40 : part * 40 + 40]
        spark.createDataFrame(piece, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        stream = seats.read_changes(spark, str(folder), "*.parquet", feed.schema)
        seats.keep_seats_current(stream, warehouse, "seats", str(tmp_path / "state")).awaitTermination()
    want = {}
    for order, space, line, quantity, at in changes:
        key = (at, order, line, int(quantity))
        want[space] = max(want.get(space, key), key)
    got = {r["space_id"]: (r["changed_at"], r["change_id"], r["change_line"], r["available_seats"])
           for r in warehouse.read("seats").collect()}
    assert got == want
    batch = seats.latest_seats(seats.seat_changes(feed)).select(warehouse.read("seats").columns)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, warehouse.read("seats").collect()))


def test_a_batch_run_twice_changes_nothing(spark, warehouse):
    rows = [(1, 5, 1, 10.0, datetime(2001, 1, 1)), (2, 5, 1, 20.0, datetime(2001, 1, 2))]
    newest = seats.latest_seats(seats.seat_changes(spark.createDataFrame(rows, SCHEMA)))
    for _ in range(2):
        known = warehouse.read("seats").unionByName(newest) if warehouse.exists("seats") else newest
        warehouse.rebuild("seats", seats.latest_seats(known))
    assert [r["available_seats"] for r in warehouse.read("seats").collect()] == [20]


def _shipped(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def _run(spark, folder, warehouse, state):
    stream = seats.read_changes(spark, str(folder), "*.parquet", spark.createDataFrame([], SCHEMA).schema)
    query = seats.keep_seats_current(stream, warehouse, "seats", str(state))
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_a_second_batch_reads_its_changes_and_rewrites_their_buckets(spark, warehouse, tmp_path):
    first = [(i, i, 1, 5.0, datetime(2001, 1, 1)) for i in range(200)]
    _shipped(spark, tmp_path / "feed", first)
    _run(spark, tmp_path / "feed", warehouse, tmp_path / "state")
    before = warehouse.partition_folders("seats", seats.BUCKET)
    assert len(before) > 50
    _shipped(spark, tmp_path / "feed", [(900, 7, 1, 9.0, datetime(2001, 1, 2)), (1, 8, 1, 9.0, datetime(2000, 1, 1))])
    progress = _run(spark, tmp_path / "feed", warehouse, tmp_path / "state")
    assert sum(p["numInputRows"] for p in progress) == 2
    after = warehouse.partition_folders("seats", seats.BUCKET)
    assert after.keys() == before.keys()
    assert len([b for b in after if after[b] != before[b]]) in (1, 2)
    seats_of = {r.space_id: r.available_seats for r in warehouse.read("seats").collect()}
    assert seats_of == {i: 9 if i == 7 else 5 for i in range(200)}


def test_a_stream_that_lost_its_state_leaves_later_changes(spark, warehouse, tmp_path):
    for state, rows in enumerate(
        [[(1, 5, 1, 20.0, datetime(2001, 1, 2)), (1, None, 1, 1.0, None)], [(2, 5, 1, 10.0, datetime(2001, 1, 1))]]
    ):
        _shipped(spark, tmp_path / f"feed{state}", rows)
        for _ in range(2):
            _run(spark, tmp_path / f"feed{state}", warehouse, tmp_path / f"state{state}")
    found = {(r.space_id, r.available_seats) for r in warehouse.read("seats").collect()}
    assert found == {(5, 20), (None, 1)}


def _landed(spark, sf_dir, tmp_path, files):
    """Versions of some bookings in files; the latest versions land first."""
    rows = landing.booking_changes(spark, sf_dir).where("booking_id < 300")
    rows = spark.createDataFrame(rows.orderBy("updated_at", "booking_id").collect(), rows.schema)
    pieces = sorted(rows.collect(), key=lambda r: (r.updated_at, r.booking_id), reverse=True)
    for i in range(files):
        piece = pieces[i * len(pieces) // files : (i + 1) * len(pieces) // files]
        spark.createDataFrame(piece, rows.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
    return rows


def _lookups(spark, sf_dir, warehouse):
    for name in ("status", "booking_types"):
        warehouse.rebuild(f"clean_{name}", clean(SOURCES[name], landing.landed(spark, sf_dir, name)))


def _rows(table):
    columns = sorted(table.columns)
    return sorted((tuple(r) for r in table.select(columns).collect()), key=str)


def _stream(spark, warehouse, tmp_path, state):
    landed = bookings.read_landed(spark, str(tmp_path / "landed"), files_per_batch=1)
    bookings.stream_bookings(
        landed, warehouse, str(tmp_path / state), bookings.MONTH, bookings.MONTH, blocking_checks=False
    ).awaitTermination()


def test_streamed_bookings_equal_the_batch_load(spark, sf_dir, warehouse, tmp_path):
    rows = _landed(spark, sf_dir, tmp_path, 3)
    _lookups(spark, sf_dir, warehouse)
    _stream(spark, warehouse, tmp_path, "state")
    current = clean(SOURCES["bookings"], rows)
    named = [warehouse.read("clean_status"), warehouse.read("clean_booking_types")]
    fact = core.fact_of_current_bookings(staging.bookings(current, *named))
    assert _rows(warehouse.read("clean_bookings")) == _rows(current)
    assert _rows(warehouse.read("fact_bookings")) == _rows(fact)
    assert warehouse.read("stg_bookings").count() == rows.count()
    # A stream that starts anew, with the same files: nothing changes, in any table.
    before = {t: _rows(warehouse.read(t)) for t in ("clean_bookings", "stg_bookings", "fact_bookings")}
    folders = warehouse.partition_folders("fact_bookings", bookings.MONTH)
    for i in range(3):
        bookings.load_batch(
            warehouse, rows.where(f"booking_id % 3 = {i}"), 100 + i, bookings.MONTH, bookings.MONTH, blocking_checks=False
        )
    assert {t: _rows(warehouse.read(t)) for t in before} == before
    assert warehouse.partition_folders("fact_bookings", bookings.MONTH) == folders


def test_a_batch_that_broke_off_is_made_up_for(spark, sf_dir, warehouse, tmp_path, monkeypatch):
    rows = _landed(spark, sf_dir, tmp_path, 1)
    _lookups(spark, sf_dir, warehouse)
    early, late = rows.where("booking_id % 2 = 0"), rows.where("booking_id % 2 = 1")

    def load(landed, batch_id):
        bookings.load_batch(warehouse, landed, batch_id, bookings.MONTH, bookings.MONTH, blocking_checks=False)

    load(early, 0)
    replace = Warehouse.replace_partitions

    def broken(self, table, *rest):
        replace(self, table, *rest)
        if table == "stg_bookings":
            raise RuntimeError("lost")

    monkeypatch.setattr(Warehouse, "replace_partitions", broken)
    try:
        load(late, 1)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert warehouse.read("fact_bookings").where("booking_id % 2 = 1").isEmpty()
    load(late, 1)
    assert warehouse.read("fact_bookings").count() == rows.select("booking_id").distinct().count()
    assert warehouse.read("stg_bookings").count() == rows.count()
    load(rows.where("false"), 2)
    assert warehouse.read("stg_bookings").count() == rows.count()


def test_a_stream_keeps_two_states_of_a_table_and_no_stage(spark, sf_dir, tmp_path, monkeypatch):
    _landed(spark, sf_dir, tmp_path, 3)
    own = Warehouse(spark, str(tmp_path / "own"), f"test_{uuid4().hex[:12]}", lasting=False)
    _lookups(spark, sf_dir, own)
    settings, load = [], bookings.load_batch

    def seen(current, *rest):
        settings.append(current.spark.conf.get(SHUFFLE_CLEANUP))
        load(current, *rest)

    monkeypatch.setattr(bookings, "load_batch", seen)
    _stream(spark, own, tmp_path, "state")
    assert settings == ["true"] * 3
    assert not [*(tmp_path / "own" / "_stage").rglob("*.parquet")]
    for table in ("clean_bookings", "fact_bookings"):
        named = set()
        for state in ("files", "files_before"):
            named |= set(own._folders(own._property(table, state), [bookings.MONTH]).values())
        on_disk = {p.parent for p in (tmp_path / "own" / table).rglob("*.parquet")}
        assert on_disk == {Path(folder.removeprefix("file:")) for folder in named}


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = [Path(folder).rglob("shuffle_*") for folder in disk.localDirsString()]
        return {f.name for found in names for f in found}

    def write(folder):
        spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / folder))

    before = files()
    write("kept")
    assert files() - before
    with short_lived_shuffles(spark):
        before = files()
        write("gone")
        until = time.time() + 20
        while files() - before and time.time() < until:
            time.sleep(0.2)
        assert not files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert spark.read.parquet(str(tmp_path / "gone")).count() == 7
