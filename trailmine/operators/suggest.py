"""Suggestions for many queries at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmine.params import SUGGESTION_LIMIT

# Everything up to the blank, at both ends.
CONTROL_OR_BLANK = r"^[\x00-\x20]+|[\x00-\x20]+$"


def wanted_queries(requests: DataFrame) -> DataFrame:
    """The different queries of requests, without blanks and control characters at their ends."""
    return requests.select(F.regexp_replace("query", CONTROL_OR_BLANK, "").alias("query")).distinct()


def suggest(clusters: DataFrame, requests: DataFrame, limit: int = SUGGESTION_LIMIT) -> DataFrame:
    """The ``limit`` best cluster rows of each requested query, with their ``rank`` from 1.

    Rows are ranked by count, then cluster id, then name. Blanks and control characters
    at the ends of requests are cut off; asking twice gives one answer.
    """
    wanted = wanted_queries(requests)
    order = Window.partitionBy("query").orderBy(F.desc("ref_count"), "cluster_id", "refinement")
    return (
        clusters.join(wanted, "query", "left_semi")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
    )


def nest_suggestions(ranked: DataFrame) -> DataFrame:
    """One row per query: its clusters by best rank, each a list of refinements by rank."""
    members = F.array_sort(F.collect_list(F.struct("rank", "refinement")))
    by_best = F.array_sort(F.collect_list("members"))
    return (
        ranked.groupBy("query", "cluster_id")
        .agg(members.alias("members"))
        .groupBy("query")
        .agg(by_best.alias("groups"))
        .select("query", F.transform("groups", lambda g: g["refinement"]).alias("suggestions"))
    )


def headline_suggestions(nested: DataFrame) -> DataFrame:
    """One row per cluster: position from 0, the first refinement, and the others."""
    return nested.select("query", F.posexplode("suggestions").alias("position", "cluster")).select(
        "query",
        "position",
        F.col("cluster")[0].alias("headline"),
        F.slice("cluster", 2, F.greatest(F.size("cluster"), F.lit(1))).alias("others"),
    )
