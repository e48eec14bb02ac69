"""Complete-link clustering of the refinements of each query."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmine.operators.walk import check_size
from trailmine.params import MIN_CLUSTERS, SIMILARITY_DIGITS

_CLUSTER_IDS = "query string, cluster_id int, refinement string"


def significant(values: np.ndarray, digits: int = SIMILARITY_DIGITS) -> np.ndarray:
    """Values to a number of significant digits; however small, a positive one stays positive."""
    unit = np.power(10.0, np.floor(np.log10(values, out=np.zeros_like(values), where=values > 0)))
    return np.round(values / unit, digits - 1) * unit


def complete_link(similarity: np.ndarray, min_clusters: int) -> list[list[int]]:
    """Merge the two most similar clusters until ``min_clusters`` are left or none are similar.

    Clusters are as similar as their least similar members. Of equal pairs the one
    latest in the list is merged; the cluster keeps the later place.
    """
    n = len(similarity)
    link = np.tril(np.maximum(similarity, similarity.T), -1)
    clusters = [[i] for i in range(n)]
    # The greatest link of each cluster to an earlier one, and the latest that has it. A merge
    # only lowers links to the two clusters, so only rows that point to these change.
    best, partner = np.zeros(n), np.zeros(n, np.int64)

    def look_again(rows: np.ndarray) -> None:
        backwards = link[rows, ::-1]
        partner[rows] = n - 1 - np.argmax(backwards, axis=1)
        best[rows] = link[rows, partner[rows]]

    for begin in range(0, n, 256):
        look_again(np.arange(begin, min(begin + 256, n)))
    for _ in range(n - min_clusters):
        # Searched from the end, so that the latest of equal pairs comes first.
        high = n - 1 - int(np.argmax(best[::-1]))
        low = int(partner[high])
        if not best[high] > 0:
            break
        merged = np.minimum(link[high] + link[:, high], link[low] + link[:, low])
        merged[[high, low]] = 0
        link[low] = link[:, low] = 0
        link[high, :high] = merged[:high]
        link[high + 1 :, high] = merged[high + 1 :]
        stale = (partner == low) | (partner == high)
        stale[[low, high]] = True
        look_again(np.flatnonzero(stale & ((best > 0) | (np.arange(n) == high))))
        clusters[high] += clusters[low]
        clusters[low] = []
    return [cluster for cluster in clusters if cluster]


def _cluster_rows(query: str, names: pd.Index, clusters: list[list[int]]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "query": query,
            "cluster_id": np.repeat(np.arange(len(clusters)), [len(c) for c in clusters]),
            "refinement": names[[i for cluster in clusters for i in cluster]],
        }
    )


def singleton_clusters(refs: DataFrame) -> DataFrame:
    """Every refinement is its own cluster, numbered by name."""
    order = Window.partitionBy("query").orderBy("refinement")
    number = (F.row_number().over(order) - 1).cast("int")
    return refs.select("query", number.alias("cluster_id"), "refinement")


def cluster_refinements(
    similarity: DataFrame, refs: DataFrame, min_clusters: int = MIN_CLUSTERS
) -> DataFrame:
    """Clusters ``query, cluster_id, refinement`` of the refinements in ``refs``.

    A pair that is absent from ``similarity`` is never merged. Only queries with
    more than ``min_clusters`` refinements are merged, in one group per query; the
    top-k step bounds its size.
    """
    sized = refs.select("query", "refinement").withColumn(
        "n_refs", F.count("*").over(Window.partitionBy("query"))
    )
    small = sized.filter(F.col("n_refs") <= min_clusters)
    large = sized.filter(F.col("n_refs") > min_clusters).drop("n_refs")
    # Every refinement also comes as a pair with itself, so that none is missing.
    itself = large.select(
        "query", "refinement", F.col("refinement").alias("co_refinement"), F.lit(0.0).alias("similarity")
    )
    pairs = similarity.join(large.select("query").distinct(), "query", "left_semi")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        names = pd.Index(sorted(set(pdf["refinement"])), dtype=object)
        check_size(len(names))
        link = np.zeros((len(names), len(names)))
        rows, columns = names.get_indexer(pdf["refinement"]), names.get_indexer(pdf["co_refinement"])
        link[rows, columns] = significant(pdf["similarity"].to_numpy())
        return _cluster_rows(pdf["query"].iloc[0], names, complete_link(link, min_clusters))

    merged = pairs.unionByName(itself).groupBy("query").applyInPandas(merge, _CLUSTER_IDS)
    return singleton_clusters(small).unionByName(merged)
