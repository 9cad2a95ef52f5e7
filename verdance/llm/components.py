"""Connected components of a table of links, by minimum labels and stars on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest of its neighbourhood."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of these.

    ``edges`` run from the larger to the smaller node.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Alternating stars halve the distance to the smallest node; each round is a
    written table, so a lost executor repeats one round at most.  A pair may be
    repeated, stand in either order, or join a node to itself; pairs with a
    missing end are no links.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "links")
    seen = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == seen:
            break
        seen = state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
