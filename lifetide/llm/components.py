"""Connected components of a link table by alternating stars (no link list leaves the executors)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import release, stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long), root being the smallest node that it reaches (staged).

    Large-star and small-star steps alternate until all is stars: every step points the neighbours of a node at the smallest of them, so paths
    halve.  Minima are partial aggregates; a hub's many links are never
    gathered in one group.
    """
    # links are far fewer than what the session's shuffles are sized for: fewer, larger files
    parts = max(8, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct().coalesce(parts), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
        # large star: neighbours above a node point at the smallest neighbour (or the node itself)
        large = (both.join(low, F.col("u") == F.col("m_u")).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        # small star: the node and its lower neighbours point at the lowest
        large = stage(large.coalesce(parts), "large-star")
        low = large.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
        joined = large.join(low, F.col("u") == F.col("m_u"))
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select(F.col("m_u").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct())
        last, edges = edges, stage(small.coalesce(parts), "small-star")
        release(last, large)
        # done once every node points at one other and no root points anywhere: every component is a star around its smallest node
        several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if several.isEmpty() and edges.join(edges.select(F.col("v").alias("r")).distinct(), F.col("u") == F.col("r"), "left_semi").isEmpty():
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = stage(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "components")
    release(edges)
    return found
