"""Operators around the refinements that share a session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PAIR_KEY = ["query", "refinement"]


def filter_by_top_refs(rows: DataFrame, top: DataFrame, clicks_only: bool = False) -> DataFrame:
    """Session rows whose (query, refinement) is in ``top``; ``clicks_only`` keeps rows with a document."""
    if clicks_only:
        rows = rows.filter(F.col("doc") != "")
    return rows.join(top.select(*_PAIR_KEY), _PAIR_KEY, "left_semi")


def co_occurrences(session_refs: DataFrame) -> DataFrame:
    """Each unordered pair of refinements of a session, smaller one first.

    Expects rows already limited to the top refinements: then a session has at
    most that many refinements, however many records it has, and its pairs are
    built inside one row instead of by a self-join.
    """
    refs = F.array_sort(F.collect_set("refinement"))
    return (
        session_refs.groupBy("session_id", "query")
        .agg(refs.alias("refs"))
        .filter(F.size("refs") > 1)
        .select("query", "refs", F.posexplode("refs").alias("pos", "refinement"))
        .select(
            "query",
            "refinement",
            F.explode(F.slice("refs", F.col("pos") + 2, F.size("refs"))).alias("co_refinement"),
            F.lit(1).alias("count"),
        )
    )


def symmetric_co_occ(co_occ: DataFrame) -> DataFrame:
    """Both directions of each pair. ``co_occ`` has one row per unordered pair."""
    both = F.array(
        F.struct(F.col("refinement").alias("a"), F.col("co_refinement").alias("b")),
        F.struct(F.col("co_refinement").alias("a"), F.col("refinement").alias("b")),
    )
    return co_occ.select("query", "count", F.explode(both).alias("pair")).select(
        "query",
        F.col("pair.a").alias("refinement"),
        F.col("pair.b").alias("co_refinement"),
        "count",
    )


def common_queries(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose query is on both sides."""
    in_left = left.select("query").distinct()
    in_right = right.select("query").distinct()
    return left.join(in_right, "query", "left_semi"), right.join(in_left, "query", "left_semi")


def attach_ref_counts(clusters: DataFrame, top: DataFrame) -> DataFrame:
    """Add the session count of each refinement as ``ref_count``."""
    counts = top.select(*_PAIR_KEY, F.col("count").alias("ref_count"))
    return clusters.join(counts, _PAIR_KEY).select(
        "query", "cluster_id", "refinement", "ref_count"
    )
