"""Connected components of a graph given as edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hotdesk.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to rows (node, component): the smallest node reachable, for all nodes of edges.

    Large-star and small-star in turn: nodes hook on to ever smaller neighbours until every
    component is a star. Neighbours are never listed, only their minimum is taken. Rounds are
    written to the shared folder; their number grows with the logarithm of the diameter.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: larger neighbours move to the smallest node around.
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the node and its smaller neighbours move to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hooked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = least.select("a", F.col("m").alias("b"))
        edges = stored(hooked.unionByName(star).where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
