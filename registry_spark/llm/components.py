"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.sources.shared import written


def star(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node; a node with very many links is reduced where it is read."""
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """node and component (smallest node it reaches) of every linked node but the smallest ones themselves.

    ``links`` has columns a and b. Each round hangs larger neighbours, then all neighbours, of a node on the smallest
    one (Kiveris et al., "Connected components in MapReduce and beyond"); the number of links never grows, and rounds
    are logarithmic. Each is written to the shared folder. Repeated links and loops do no harm.
    """
    edges = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(star(both), "a").filter("b > a").select(
            F.col("b").alias("a"), F.least("a", "least").alias("b")
        ).distinct()
        small = large.join(star(large), "a")
        hung = small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = written(hung.unionByName(small.select("a", F.col("least").alias("b"))).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    hung = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    return edges.join(hung.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and hung.filter("n > 1").isEmpty()
