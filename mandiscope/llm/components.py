"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.session import written


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node.

    ``links`` has long columns ``a`` and ``b``; direction, repeats and loops do not matter, rows with a null are
    left out. Returns ``node``, ``root`` for every node that has a link to another; no links give no rows.

    Each round ties the larger neighbours of every node to the least node of its neighbourhood, then the smaller
    ones, which needs a number of rounds that grows with the logarithm of the longest path. Neighbourhoods are only
    reduced to their minimum, never gathered, so a node may have any number of links.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first, so that the links of a hub can be split at the join.
        nearest = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
        large = (
            both.join(nearest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
        if seen == state:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = seen
