"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node it is connected with) for every node that is not the smallest.

    Alternates two star operations: every node's larger neighbours are linked to its smallest one,
    then its smaller neighbours are. The number of rounds grows with the logarithm of the size; the
    edges of each round are written, which cuts the lineage. A node's smallest neighbour is found by
    an aggregation that starts before the shuffle, so a node with very many edges is no hot group.
    """
    now = stored(oriented(edges.select("a", "b")), "edges")
    size = summary(now)
    while True:
        now = stored(small_star(large_star(now)), "edges")
        last, size = size, summary(now)
        if last == size:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node a to the smaller node b."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return oriented(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return oriented(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def summary(edges: DataFrame) -> tuple:
    """Changes whenever the edges do (up to a 64-bit hash)."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
