"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has an edge; the root is the least node of its component.

    Alternating large-star and small-star steps: every node is linked to the least of its neighbours until
    all of a component are linked to its least node. Each round is a written table, so that a lost executor
    costs one round. Neighbours are only ever reduced to a minimum, never gathered. Input: distinct pairs
    ``(u, v)`` of longs with ``u <> v``; no edges give no rows.
    """
    edges = session.stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = session.stage(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_anti")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
