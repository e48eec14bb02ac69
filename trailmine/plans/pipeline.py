"""The whole chain from log rows to counted clusters, and its intermediate levels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.operators.clustering import cluster_refinements, singleton_clusters
from trailmine.operators.cooccurrence import (
    attach_ref_counts,
    co_occurrences,
    filter_by_top_refs,
)
from trailmine.operators.counts import (
    count_co_occurrences,
    count_docs,
    count_refinements,
    first_session_refs,
    top_docs,
    top_refinements,
)
from trailmine.operators.sessions import mark_sessions
from trailmine.operators.walk import (
    doc_steps,
    ref_steps,
    reference_rows,
    similarity_from_products,
    vector_products,
)
from trailmine.params import (
    DOC_ROWS_PER_TASK,
    DOUBLINGS,
    EPSILON,
    MIN_CLUSTERS,
    SESSION_SPAN_S,
    TOP_REFINEMENTS,
)
from trailmine.storage import materialise, materialise_together


@dataclass(frozen=True)
class Settings:
    """Parameters of the pipeline. ``docs_per_ref=None`` keeps all documents of a refinement."""

    span_s: int = SESSION_SPAN_S
    seed_queries: Sequence[str] | DataFrame | None = None
    strict: bool = False
    refs_per_query: int = TOP_REFINEMENTS
    docs_per_ref: int | None = None
    epsilon: float = EPSILON
    doublings: int = DOUBLINGS
    mode: str = "max_product"
    min_clusters: int = MIN_CLUSTERS
    blocks: int | None = None
    doc_rows_per_task: int = DOC_ROWS_PER_TASK


def sessions_of(log: DataFrame, settings: Settings) -> DataFrame:
    """Marked session rows."""
    return mark_sessions(
        log, settings.span_s, settings.seed_queries, settings.strict, settings.blocks
    )


def top_of(marked: DataFrame, settings: Settings) -> DataFrame:
    """Top refinements of marked session rows."""
    counts = count_refinements(first_session_refs(marked))
    return top_refinements(counts, settings.refs_per_query)


def co_occ_of(marked: DataFrame, top: DataFrame) -> DataFrame:
    """Co-occurrence counts of the top refinements."""
    # Filtering before the pairs are built bounds the pairs of a session.
    rows = filter_by_top_refs(first_session_refs(marked), top)
    return count_co_occurrences(co_occurrences(rows))


def docs_of(marked: DataFrame, top: DataFrame, settings: Settings) -> DataFrame:
    """Click counts of the top refinements."""
    # Counted first: after a join on (query, refinement) Spark would count without a
    # further shuffle, and a very frequent pair would pass through one task row by row.
    clicks = marked.filter(F.col("doc") != "").select("query", "refinement", "doc", "count")
    return filter_by_top_refs(top_docs(count_docs(clicks), settings.docs_per_ref), top)


def cluster_ids(sessions: DataFrame, top: DataFrame, settings: Settings) -> DataFrame:
    """``query, cluster_id, refinement`` of written-down sessions and top refinements."""
    co_occ, docs = materialise_together(
        {"co-occ": co_occ_of(sessions, top), "doc-counts": docs_of(sessions, top, settings)}
    )
    return clusters_of_counts(co_occ, docs, settings)


def clusters_of_counts(co_occ: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """``query, cluster_id, refinement`` of written-down count tables.

    Queries of at most ``min_clusters`` refinements merge nothing, so only the
    others go through the random walk. Their documents are dealt to tasks in parts of
    ``doc_rows_per_task`` rows, one part for most queries.
    """
    rows = materialise(reference_rows(co_occ, docs), "walk-refs")

    large = rows.filter(F.col("n_refs") > settings.min_clusters)
    small = rows.filter(F.col("n_refs") <= settings.min_clusters)
    products = vector_products(
        ref_steps(co_occ, large, settings.epsilon),
        doc_steps(docs, large, settings.epsilon),
        settings.doublings,
        settings.doc_rows_per_task,
    )
    # The norms and the pairs are both taken from the products.
    similarity = similarity_from_products(materialise(products, "products"), settings.mode)
    merged = cluster_refinements(similarity, large, settings.min_clusters)
    return singleton_clusters(small).unionByName(merged)


def cluster_pipeline(log: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``query, cluster_id, refinement, ref_count`` of a log.

    Sessions, top refinements and both count tables have several consumers and are
    written to the shared folder once.
    """
    sessions = materialise(sessions_of(log, settings), "sessions")
    top = materialise(top_of(sessions, settings), "top-refs")
    return attach_ref_counts(cluster_ids(sessions, top, settings), top)


def run_level(log: DataFrame, level: str = "", settings: Settings = Settings()) -> DataFrame:
    """The rows of a level; any other name stands for the whole pipeline."""
    if level == "logMap":
        return log
    if level == "test":
        return log.select("user_id")
    if level == "sessionConstruction":
        return sessions_of(log, settings).drop("is_first")
    if level == "singleSessions":
        return first_session_refs(sessions_of(log, settings))
    if level == "countRef":
        return count_refinements(first_session_refs(sessions_of(log, settings)))
    if level == "topCountRef":
        return top_of(sessions_of(log, settings), settings)
    if level == "cluster":
        sessions = materialise(sessions_of(log, settings), "sessions")
        top = materialise(top_of(sessions, settings), "top-refs")
        return cluster_ids(sessions, top, settings)
    return cluster_pipeline(log, settings)
