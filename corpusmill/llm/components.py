"""Connected components of a table of links, without gathering links or components on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links (a, b: long, non-null), component the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each is one shuffle of the links, partial
    aggregation keeps a hub's rows from gathering, and the rounds grow with the logarithm of the size. Every round is
    written to the shared folder and replaces the one before. ``most_rounds`` is a guard against a fault, not a cut: reaching it raises.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        if large:
            both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges.select(high.alias("a"), low.alias("b"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.join(least, F.col("a") == F.col("u"))
        if large:
            out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    edges = written(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        before, edges = edges, written(star(star(edges, True), False), "links")
        discard(before)
        # edges point from a node to a smaller one; unchanged sums over all of them mean that the stars stand
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            out = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
            out.written_path = edges.written_path
            return out
        mark = now
    raise RuntimeError("the links did not settle")
