"""Connected components of edges that are too many for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.sources.shared import materialize


def least_reachable(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, least) for each node of edges (keys, a, b) that reaches a lesser one: edges join nodes of the same keys, which are numbers. In each
    round every node is tied to the least of its greater neighbours' nodes, then of its lesser ones', until all edges point to their least node;
    rounds grow with the logarithm of the nodes. Each round is written to the shared folder."""

    def stamp(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*keys, "a", "b"))).first()

    larger = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(edges.where("a <> b").select(*keys, *larger).distinct())
    last = stamp(edges)
    while True:
        both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(*keys, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        up = both.join(least, [*keys, "a"]).where("b > a and b <> m").select(*keys, F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = up.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        down = up.join(least, [*keys, "a"]).select(*keys, F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(down.where("a <> b").distinct())
        now = stamp(edges)
        if now == last:
            return edges.select(*keys, F.col("a").alias("node"), F.col("b").alias("least"))
        last = now
