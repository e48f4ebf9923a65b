"""Cost-balanced packing of token ids into sequences of bounded length.

The attention cost of a piece is estimated as ``linear * n + quadratic * n * n``. Pieces are
taken in descending cost; each goes to the sequence of lowest cost that still has room for
it. Documents longer than a sequence are cut into full pieces and a rest; a piece that no
sequence has room for is cut to fill the roomiest ones. So a batch of pieces fills exactly
as many sequences as its ids need, and pads less than one sequence.

Packing is local to an input partition and bounded batches of ids, so it needs no shuffle and
no hot source, copy group or long document can gather in one task. The same partition gives
the same sequences again when a task is repeated.

Defined results: a NULL or empty text is one piece with the closing id alone; repeated rows
are packed each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hotdesk.llm.tokens import encoder

LENGTH = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Ids that are packed together.
BATCH = 1 << 20

SCHEMA = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


def balanced(sizes: np.ndarray, length: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int]]:
    """Places pieces of at most ``length`` ids: yields (piece, start in it, ids, sequence)."""
    count = -(-int(sizes.sum()) // length)
    cost, room = np.zeros(count), np.full(count, length)
    # Cost grows with size, so descending sizes are descending costs.
    for piece in np.argsort(-sizes, kind="stable").tolist():
        start, left = 0, int(sizes[piece])
        while left:
            fits = room >= left
            if fits.any():
                sequence = int(np.where(fits, cost, np.inf).argmin())
                take = left
            else:
                sequence = int(room.argmax())
                take = int(room[sequence])
            cost[sequence] += linear * take + quadratic * take * take
            room[sequence] -= take
            yield piece, start, take, sequence
            start, left = start + take, left - take


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: its document and place there, its ids (little-endian unsigned 32 bit),
    the document's ids in all, and its place in a sequence. Sequence ids are unique."""
    shape = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
        + [(name, pa.int64()) for name in ("doc_tokens", "sequence_id", "offset")]
    )

    def packed(pieces: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
        """Rows of the pieces (doc_id, start, ids, doc_tokens) and the next free sequence."""
        sizes = np.array([len(piece[2]) for piece in pieces])
        filled: dict[int, int] = {}
        columns: list[list] = [[] for _ in shape]
        for at, skip, take, sequence in balanced(sizes, length, linear, quadratic):
            doc, start, ids, total = pieces[at]
            offset = filled.get(sequence, 0)
            filled[sequence] = offset + take
            row = (doc, start + skip, ids[skip : skip + take].astype("<u4").tobytes(), total, first + sequence, offset)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        arrays = [pa.array(column, field.type) for column, field in zip(columns, shape, strict=True)]
        return pa.record_batch(arrays, schema=shape), first + len(filled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 33
        pieces, held = [], 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(body.as_py())
                for start in range(0, len(ids), length):
                    pieces.append((doc, start, ids[start : start + length], len(ids)))
                held += len(ids)
                if held >= BATCH:
                    rows, sequence = packed(pieces, sequence)
                    pieces, held = [], 0
                    yield rows
        if pieces:
            yield packed(pieces, sequence)[0]

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, SCHEMA)


def digest(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with a checksum in place of the ids."""
    return pack(docs).select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
