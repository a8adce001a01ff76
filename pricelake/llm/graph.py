"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Links in both directions with the least of each node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"),
                                          F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its least node) of the nodes of a link table (a, b).

    Large and small star steps (links to larger neighbours, then to smaller
    ones, move to the least neighbour) alternate until nothing changes.  Each
    round is stored; a hub's links are combined before they are shuffled and
    its join rows are split by Spark's skew join.
    """
    edges = stored(links.select(F.least("a", "b").alias("b"),
                                F.greatest("a", "b").alias("a"))
                   .where("a <> b").distinct(), name)
    state = None
    while True:
        n = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast(
            "decimal(38,0)"))).first()
        if state == n or not n[0]:
            break
        state = n
        large = _least_neighbour(edges).where("b > a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        # now every link points from a larger to a smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"),
                                              F.col("m").alias("b"))
        edges = stored(small.where("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct(), name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"),
                                  F.col("b").alias("component")).distinct())
