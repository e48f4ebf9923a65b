"""Exact top-k by integer inner product: columnar branch and bound.

Vectors lie in vertical layout, one row of a matrix per dimension. For a query the products
of one block of dimensions after the other are added up; what the rest can still add or take
away is at most the product of both remaining lengths (Cauchy-Schwarz). Candidates that
cannot reach the k-th best score any more are compacted away, so later blocks touch few.

Queries and rows meet in tiles of bounded size: every block of queries with every block of
rows, each tile in a task of its own; each gives its k best, a window keeps the k best of all.

Defined results: rows without an id, without a vector, or with a NULL or non-finite component
take no part; a shorter vector counts as filled up with zeros; repeated rows are rows of
their own; scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows and queries of a tile; dimensions that are added up at a time; exact scores that set the first bound.
TILE_ROWS, TILE_QUERIES, DIMENSIONS, PROBES = 8192, 2048, 16, 16


def integers(embedding: Column, scale: int) -> Column:
    """The components scaled and floored."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def usable(embedding: Column) -> Column:
    """Whether all components are finite numbers."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    )
    return embedding.isNotNull() & finite


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as a matrix of ``width`` rows, a column per list."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return np.ascontiguousarray(out.T)


def best(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """For each query (column) its ``k`` best rows as (query, row, score) arrays.

    Ties go to smaller ids. A row whose id is the query's own is no candidate.
    """
    exact = np.abs(rows).max(initial=1).astype(float) * np.abs(queries).max(initial=1) * max(len(rows), 1)
    kind = np.float64 if exact < 2**52 else np.int64
    rows, queries = rows.astype(kind), queries.astype(kind)
    cuts = list(range(0, len(rows), DIMENSIONS)) or [0]

    def rest(of: np.ndarray) -> list[np.ndarray]:
        return [np.sqrt(np.square(of[cut:].astype(np.float64)).sum(axis=0)) for cut in [*cuts[1:], len(of)]]

    row_rest, query_rest = rest(rows), rest(queries)
    found = []
    for q in range(queries.shape[1]):
        query = queries[:, q]
        alive = np.flatnonzero(ids != own[q])
        partial = query[:DIMENSIONS] @ rows[:DIMENSIONS]
        partial = partial[alive]
        if len(alive) > max(k, PROBES):
            first = alive[np.argpartition(partial, -PROBES)[-PROBES:]] if PROBES >= k else alive
            bound = np.partition(query @ rows[:, first], -k)[-k]
        else:
            bound = None
        for i, cut in enumerate(cuts):
            if i:
                partial = partial + query[cut : cut + DIMENSIONS] @ rows[cut : cut + DIMENSIONS, alive]
            if bound is not None:
                # The difference is exact; it is compared with what the rest can add, rounded up.
                keep = bound - partial <= query_rest[i][q] * row_rest[i][alive] * (1 + 1e-9) + 1
                alive, partial = alive[keep], partial[keep]
        top = np.lexsort((ids[alive], -partial))[:k]
        found.append((np.full(len(top), q), alive[top], partial[top].astype(np.int64)))
    return (np.concatenate(part) for part in zip(*found, strict=True))


def search(rows: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """The ``k`` best rows of every query: query_id, rank (from 1), vec_id, score.

    Both tables hold a long id and an array of longs. A query's candidates are all rows but
    those with its own id.
    """
    one = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")

    def taken(table: DataFrame) -> DataFrame:
        named = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
        return named.where("id IS NOT NULL AND v IS NOT NULL").withColumn("row", F.monotonically_increasing_id())

    rows, queries = taken(rows), taken(queries)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = max(size["width"] or 0, asked["width"] or 0)
    row_blocks, query_blocks = -(-size["n"] // TILE_ROWS), -(-asked["n"] // TILE_QUERIES)

    def tiles(table: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "row"), F.lit(max(blocks, 1)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(others, 1) - 1).cast("long")))
        return table.withColumn(own, block).withColumn(other, every).groupBy("rows_of", "queries_of")

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        asked_rows = right.column("row").to_numpy()
        own = right.column("id").to_numpy()
        ids = left.column("id").to_numpy()
        if not len(ids) or not len(own):
            return pa.table({"query_row": [], "query_id": [], "vec_id": [], "score": []}, schema=shape)
        q, at, score = best(_matrix(left.column("v"), width), ids, _matrix(right.column("v"), width), own, k)
        return pa.table(
            {"query_row": asked_rows[q], "query_id": own[q], "vec_id": ids[at], "score": score}, schema=shape
        )

    shape = pa.schema([(name, pa.int64()) for name in ("query_row", "query_id", "vec_id", "score")])
    found = (
        tiles(rows, "rows_of", row_blocks, "queries_of", query_blocks)
        .cogroup(tiles(queries, "queries_of", query_blocks, "rows_of", row_blocks))
        .applyInArrow(tile, "query_row long, query_id long, vec_id long, score long")
    )
    return (
        found.withColumn("rank", F.row_number().over(one))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``; candidates all other rows."""
    rows = embeddings.where(usable(F.col("embedding"))).select(
        "vec_id", integers(F.col("embedding"), scale).alias("vector")
    )
    return search(rows, rows.where(F.col("vec_id") % every == 0), k)
