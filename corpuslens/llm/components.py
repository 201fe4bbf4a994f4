"""Connected components by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).union(
        least.select(F.col("a"), F.col("m"))
    )


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: `root` is the smallest node reachable.

    `edges` has two long columns a and b; direction, repeats and self-links don't matter, rows with a null are no
    links. A hub's links are only joined to one row each, so Spark can split them. Ends when a round changes nothing.
    """
    now = cut_lineage(edges.select("a", "b").filter("a != b").distinct())
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state, now = mark, cut_lineage(_tidy(_small_star(_tidy(_large_star(now)))))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
