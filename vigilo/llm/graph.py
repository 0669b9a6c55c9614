"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node that can be reached.

    Alternating large-star and small-star contraction: the number of rounds grows with the logarithm
    of the longest path. A node's smallest neighbour comes from an aggregation with map-side combine, is
    written as a table, and goes back by a join: between two plain sides adaptive execution can split the
    rows of a node with very many links over tasks, which it doesn't do for a side that is still an
    aggregate. Each round is a table in the shared folder; null nodes and loops are left out. No links give no rows.
    """
    edges = stage(
        links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links")
    before = None
    while True:
        # large star: every larger neighbour of a node is tied to the node's smallest neighbour (or itself)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                      .where("hi <> lo").distinct(), "large-star")
        # small star: a node and its smaller neighbours are tied to the smallest of them
        least = stage(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        tied = large.join(least, "hi")
        edges = stage(tied.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                      .union(least.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(edges.select("lo", "lo")).distinct())
