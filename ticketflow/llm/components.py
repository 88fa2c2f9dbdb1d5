"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from every node of `edges` (a, b).

    Large-star and small-star steps in turn, each a grouped minimum joined
    back to the edges, so a node with very many neighbours is never gathered
    in one place. Stops when a round changes nothing; rounds grow with the
    logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = cut_lineage(edges)
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = cut_lineage(small)
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return _labels(edges)
        mark = seen


def _labels(stars: DataFrame) -> DataFrame:
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots).distinct()
