"""Packed id matrices: best-fit-decreasing packing, segment lengths and position resets.

Documents longer than a row are split into full rows and a rest, nothing is lost; the rests,
longest first, each go to the row whose room is the smallest that suffices. A segment tree
over room sizes finds it in as many steps as the row length has bits.

Packing is local to an input partition and bounded batches of ids: no shuffle, and nothing
that grows with a hot source, group of copies or long document. Each result row is a row of
the matrix in binary form, so the table, written as Parquet, is the training input.

Defined results: a NULL or empty text is a segment of the closing id alone; repeated rows are
packed each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hotdesk.llm.tokens import encoder

WIDTH = 1024
PAD = 0
#: Ids that are packed together.
BATCH = 1 << 21

SCHEMA = (
    "row_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
    "doc_ids array<long>, doc_starts array<long>"
)


class Rooms:
    """Open rows by room, with a segment tree of how many there are per range of rooms."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a row of the smallest room of at least ``least``: (room, row)."""
        node = self.leaves + least
        while not self.counts[node]:
            while node & 1:  # a right child: everything larger lies beyond its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.counts[2 * node])
        room = node - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += change
            node >>= 1


def best_fit(sizes: list[int], width: int) -> list[list[int]]:
    """Rows of pieces, each of at most ``width`` ids in all."""
    rooms, rows = Rooms(width), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        if found := rooms.take(size):
            room, row = found
            rows[row].append(piece)
        else:
            room, row = width, len(rows)
            rows.append([piece])
        rooms.add(room - size, row)
    return rows


def matrices(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    pad: int = PAD,
    vocabulary: str | None = None,
    kind: str = "<u2",
) -> DataFrame:
    """One row per matrix row: ``ids`` and ``positions`` (``width`` numbers of ``kind``, padded), the used
    ids, cumulative segment lengths from 0, and the document and place there of each segment.

    Positions begin at 0 in every segment and in the padding. ``kind`` must hold all ids.
    """

    def packed(pieces: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
        columns: list[list] = [[] for _ in range(7)]
        rows = best_fit([len(ids) for _, _, ids in pieces], width)
        for row, segments in enumerate(rows):
            cumulative = np.cumsum([0, *(len(pieces[i][2]) for i in segments)]).astype(np.int32)
            used = int(cumulative[-1])
            ids, positions = np.full(width, pad, kind), np.zeros(width, kind)
            ids[:used] = np.concatenate([pieces[i][2] for i in segments])
            positions[:used] = np.arange(used) - np.repeat(cumulative[:-1], np.diff(cumulative))
            values = (
                first + row, used, ids.tobytes(), cumulative, positions.tobytes(),
                [pieces[i][0] for i in segments], [pieces[i][1] for i in segments],
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        types = [
            pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
            pa.list_(pa.int64()), pa.list_(pa.int64()),
        ]
        names = "row_id n_tokens ids cu_seqlens positions doc_ids doc_starts".split()
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names), first + len(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        row = TaskContext.get().partitionId() << 33
        pieces, held = [], 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(body.as_py())
                if len(ids) and ids.max() > np.iinfo(kind).max:
                    raise ValueError(f"an id does not fit {kind}")
                pieces += [(doc, start, ids[start : start + width]) for start in range(0, len(ids), width)]
                held += len(ids)
                if held >= BATCH:
                    rows, row = packed(pieces, row)
                    pieces, held = [], 0
                    yield rows
        if pieces:
            yield packed(pieces, row)[0]

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, SCHEMA)


def write(rows: DataFrame, folder: str) -> None:
    """The matrix rows as Parquet files."""
    rows.write.mode("errorifexists").parquet(folder)
