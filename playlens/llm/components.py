"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any ordered type, in either direction, repeats and loops allowed, to (node, root): the
    smallest node that each node reaches, itself included. Nodes without an edge to another node, and edges with a null
    end, are absent.

    Each round is two aggregates and two joins on a node. A node with a third of all edges is pre-aggregated before
    its shuffle (``min``) and its rows are split by the adaptive skew join; no neighbour list is ever collected.
    Rounds grow with the logarithm of the longest chain. Each is written to the shared folder.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _mark(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.distinct(), "large-star")  # every larger neighbour to the smallest
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = checkpointed(small.where("a <> b").distinct(), "small-star")  # itself and its smaller neighbours to the smallest
        last, seen = seen, _mark(now)
        if seen == last:
            break
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots.select("b", "b"))


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: the rounds have ended when it stays."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.bit_xor(h)).first())
