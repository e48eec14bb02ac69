"""Connected components of a table of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.storage import materialise


def _stars(links: DataFrame, both_ways: bool) -> DataFrame:
    """Link every larger neighbour (or every smaller one) of a node to the smallest of its neighbourhood."""
    ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both_ways else links
    least = ways.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    # Written down, so that the join of a node of many links can be split.
    least = materialise(least, "least")
    if both_ways:
        joined = ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        others = ways.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        joined = others.union(least.select("a", F.col("least").alias("b")))
    return joined.filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for all nodes of links ``(a, b)``.

    Alternates two star steps until the links stay the same; every step is a combined
    minimum, a join and a distinct, so that a node of many links is never one task's
    burden. Nodes without links do not appear.
    """
    spark = links.sparkSession
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = materialise(ordered.filter("a > b").distinct(), "links"), None
    while True:
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == before:
            break
        before = mark
        if not mark[0]:
            break
        now = materialise(_stars(_stars(now, True), False), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
