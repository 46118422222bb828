"""Connected components of an edge table, by alternating star contraction.

Every round links the larger neighbours of each node to its least neighbour (large star) and
then its smaller neighbours and itself to the least of them (small star). Only minima and
joins are needed, never a list of a node's neighbours, so a hub costs no more than its rows.
The rounds end when a round changes nothing; that takes about log n of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _least(edges: DataFrame) -> DataFrame:
    """``(u, m)``: the least of u and its neighbours, for edges (u, v) listed from u's side."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1_000_000_007)))).first()
    return row[0], row[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the least node reachable.

    Nodes are of any type with an order; null ends and loops are passed over. No edges: no rows.
    """
    now = shared.keep(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = shared.keep(_least(both))
        large = shared.keep(
            both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # now every edge leads from a node to a smaller one
        low = shared.keep(_least(large))
        linked = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = shared.keep(linked.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        state = _state(after)
        shared.drop(now, least, large, low)
        now = after
        if state == before:
            break
        before = state
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
