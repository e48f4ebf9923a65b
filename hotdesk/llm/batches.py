"""Rows in and out of Arrow batches, for tasks that walk sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows and characters of a batch that a task hands on.
ROWS, CHARACTERS = 4096, 1 << 22


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def in_batches(schema: pa.Schema, rows: Iterator[tuple[int, tuple]]) -> Iterator[pa.RecordBatch]:
    """Rows, given with their sizes, as batches of bounded size."""

    def batch(of: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*of, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    held, size = [], 0
    for own, row in rows:
        held.append(row)
        size += own
        if len(held) >= ROWS or size >= CHARACTERS:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)
