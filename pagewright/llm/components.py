"""Connected components of a link table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.frames import written


def _least_neighbours(edges: DataFrame) -> DataFrame:
    """(node, least): the least of a node and its neighbours; counted before the shuffle."""
    return edges.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: of every linked node the least node of its component.

    Each step writes its links to the shared folder, so the lineage stays short and a lost
    executor costs one step. The number of steps grows with the logarithm of the longest chain.
    """
    a, b = links.columns
    edges = written(links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        # Large star: link each neighbour greater than the node to the least around the node.
        large = both.join(_least_neighbours(both), "node").where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
        large = large.where("node <> other").distinct()
        # Small star: link the node and its lesser neighbours to the least of them.
        down = large.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        least = down.groupBy("node").agg(F.min("other").alias("least"))
        small = down.join(least, "node").select(F.explode(F.array("node", "other")).alias("node"), F.col("least").alias("other"))
        edges = written(small.where("node <> other").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if before == state:
            break
        before = state
    roots = edges.groupBy("node").agg(F.min("other").alias("root"))
    own = edges.select(F.col("other").alias("node")).distinct().join(roots.select("node"), "node", "left_anti")
    return roots.union(own.select("node", F.col("node").alias("root")))
