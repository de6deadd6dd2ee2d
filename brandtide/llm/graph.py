"""Connected components of links between integer ids, by alternating large and small stars.

Each round sends every node's larger neighbours to its smallest neighbour, then likewise the smaller ones, until
each component is a star around its smallest id. Minima are aggregated before rows are shuffled, and no task or
driver ever holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.runtime import staged


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest id reachable) for every id in ``links`` (columns a, b)."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = staged(small, "links-small")
        # Stars are reached once every node has one edge, to a node that has none.
        more = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        inner = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        if more.unionByName(inner).isEmpty():
            break
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
