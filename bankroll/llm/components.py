"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    return (tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable over the undirected edges, for every
    node that has an edge to another one. Self loops, repeated edges and edges with a null
    end tie nothing. Rounds follow until the edges stay as they are (about the logarithm of
    the largest component); each is written to the shared folder. A hub with very many
    neighbours only ever meets one row (its least neighbour) in a join."""
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                  .filter("a <> b").distinct(), "cc")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
                       .alias("h")).first()
        if mark == seen or not mark["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = mark
        now = written(_small_star(_large_star(now)), "cc")
