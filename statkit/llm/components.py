"""Connected components of an edge table by star contraction, with one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of edges (a, b; any order) the smallest node reachable from it.

    Alternates large-star and small-star rounds until every edge points to its component's smallest node; each round halves
    the distances, and an edge table never has more rows than the one before plus its nodes. A hub's edges are handled by
    joins and partial aggregates, so no node's neighbours are gathered in one task. No edges: no rows.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        small = stored(small.filter("a <> b").distinct(), "edges")
        done = small.join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if not done.take(1):
            return small.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = small
