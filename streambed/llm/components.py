"""Connected components of a graph given as pairs of long node names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.llm import common


def _edges(df: DataFrame) -> DataFrame:
    """Each edge once, from its larger end ``u`` to its smaller ``v``."""
    return (
        df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )


def _nearest(df: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest name among u and its neighbours in ``df``."""
    low = df.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return df.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge; ``root`` is the smallest node that it reaches.

    Alternating star contraction: every node hands its smallest neighbour to the larger ones, then to
    the smaller ones, until the edges are stars. A node's neighbours are only ever aggregated and
    joined, so that one with very many is split over tasks. Each round is a written table.
    """
    now, before = common.written(_edges(edges.toDF("u", "v")), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 30))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )
        before = state
        both = now.union(now.select("v", "u"))
        large = _edges(_nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        near = _nearest(large)
        small = near.select("u", F.col("m").alias("v")).union(near.select(F.col("v").alias("u"), F.col("m")))
        now = common.written(_edges(small), "edges")
