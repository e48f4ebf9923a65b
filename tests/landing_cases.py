"""Small landed tables with several versions per id, for load tests."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from hotdesk.schemas import SOURCES

START = datetime(2001, 4, 1)
Rows = dict[str, list[tuple]]


def landed_rows(rng: random.Random, clean_bookings: bool = True) -> Rows:
    """Rows of all nine tables.  Load times are distinct per table, so no load loses ties."""
    clock: dict[str, int] = {}

    def loaded(table: str) -> datetime:
        clock[table] = clock.get(table, 0) + rng.randint(1, 90)
        return START + timedelta(minutes=clock[table])

    def versions(table: str, ids: range, count: int, make) -> list[tuple]:
        picks = [*ids, *[rng.choice(ids) for _ in range(count)]]
        return [make(i, loaded(table)) for i in picks]

    def booking(i: int, at: datetime) -> tuple:
        cancelled, missed = rng.random() < 0.2, rng.random() < 0.2
        day = rng.randrange(20010401, 20010410)
        check_in = START + timedelta(days=rng.randrange(9), minutes=rng.randrange(1440))
        known = rng.random() < 0.8 and not (clean_bookings and cancelled)
        check_out = check_in + timedelta(minutes=rng.randrange(300)) if known and rng.random() < 0.9 else None
        return (
            i, day, rng.randrange(4), rng.randrange(6), rng.randrange(5), rng.randrange(3), rng.randrange(3),
            rng.randrange(1, 4), rng.randrange(1, 4), float(rng.randrange(1, 50)), float(rng.randrange(10_000)),
            check_in if known else None, check_out, -23.5, -46.6, cancelled, missed, rng.random() < 0.1,
            rng.choice(["ios", "web"]), START, at,
        )

    def space(i: int, at: datetime) -> tuple:
        seats = rng.randrange(1, 40)
        return (
            i, f"space {i}", f"space-{i}", "Brasil", "city", f"area {i % 2}", "street", -23.4, -46.5, "zone",
            "office", "category", "level", f"tier{rng.randrange(3)}", seats, rng.randrange(seats + 1), 1, True, START, at,
        )

    def company(i: int, at: datetime) -> tuple:
        return (i, f"company {i}", "industry", rng.choice([None, 10, 100, 500, 5000]), True, START, at)

    def plan(i: int, at: datetime) -> tuple:
        return (i, f"plan {i}", "type", rng.choice([0, 20, 100]), float(rng.randrange(50, 500)), True, START, at)

    def user(i: int, at: datetime) -> tuple:
        return (i, f"user {i}", f"user{i}@site.example", f"+55119{rng.randrange(10**7):07d}", True, START, at)

    return {
        "bookings": versions("bookings", range(40), 40, booking),
        "spaces": versions("spaces", range(4), 12, space),
        "companies": versions("companies", range(5), 6, company),
        "plans": versions("plans", range(3), 4, plan),
        "users": versions("users", range(6), 6, user),
        "status": [(i, f"status {i}", "text", loaded("status")) for i in range(1, 3)],
        "booking_types": [(i, f"type {i}", True, loaded("types")) for i in range(1, 3)],
        "office_groups": [(i, f"group {i}", START, loaded("groups")) for i in range(3)],
        "reasons": [(i, f"reason {i}", loaded("reasons")) for i in range(2)],
    }


def frames(spark: SparkSession, rows: Rows) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame(rows[name], SOURCES[name].schema) for name in SOURCES}


def splits(rows: Rows, parts: int) -> list[Rows]:
    """Growing prefixes of every table in load order; parents are there from the start."""
    grown = []
    for part in range(1, parts + 1):
        cut = {}
        for name, lines in rows.items():
            versioned = name in ("bookings", "spaces", "companies", "plans", "users")
            first = 1 if name in ("bookings", "spaces") else len({line[0] for line in lines})
            cut[name] = lines[: max(first, len(lines) * part // parts)] if versioned else lines
        grown.append(cut)
    return grown
