"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findlark.config import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``edges`` (two long columns); the root is the smallest node.

    Large and small stars in turn: each round is two grouped minima, combined before they are
    shuffled, and joins with them; it is written to the shared folder, so a lost executor costs
    one round. A node with most of the edges is one key of a join that Spark may split.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    edges = materialise(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.count_distinct("a")).first()
        # one edge per node and nothing moved: every node points to its root
        if now == state and now[0] == now[2]:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
