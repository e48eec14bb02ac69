"""Counting and top-k operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmine.params import FIELD_BUCKETS_AT_MOST, MIN_FIELD_COUNT, TOP_DOCS, TOP_REFINEMENTS
from trailmine.storage import materialise

_SESSION_REF = ["session_id", "query", "refinement"]


def _sum_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("count"))


def _top(counts: DataFrame, k: int, group: list[str], item: str) -> DataFrame:
    """The ``k`` largest counts per group; ties go to the smaller item.

    Spark keeps at most ``k`` rows per group on the map side, so a large group is
    cut before it is shuffled.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("count"), item))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def distinct_session_refs(sessions: DataFrame) -> DataFrame:
    """One row per refinement of a session, counting once."""
    return sessions.select(*_SESSION_REF).distinct().withColumn("count", F.lit(1))


def first_session_refs(marked: DataFrame) -> DataFrame:
    """The same from the rows of ``mark_sessions``, without a shuffle."""
    return marked.filter("is_first").select(*_SESSION_REF, "count")


def count_refinements(session_refs: DataFrame) -> DataFrame:
    """Number of sessions per (query, refinement)."""
    return _sum_counts(session_refs, "query", "refinement")


def count_co_occurrences(co_occurrences: DataFrame) -> DataFrame:
    """Number of sessions per (query, refinement, co_refinement)."""
    return _sum_counts(co_occurrences, "query", "refinement", "co_refinement")


def count_docs(click_rows: DataFrame) -> DataFrame:
    """Number of session rows per (query, refinement, doc)."""
    return _sum_counts(click_rows, "query", "refinement", "doc")


def top_refinements(ref_counts: DataFrame, k: int = TOP_REFINEMENTS) -> DataFrame:
    """The ``k`` most frequent refinements of each query."""
    return _top(ref_counts, k, ["query"], "refinement")


def top_docs(doc_counts: DataFrame, k: int | None = TOP_DOCS) -> DataFrame:
    """The ``k`` most clicked documents of each (query, refinement); all of them for ``None``."""
    return doc_counts if k is None else _top(doc_counts, k, ["query", "refinement"], "doc")


def in_frequent_buckets(keys: DataFrame, min_count: int, buckets: int) -> DataFrame:
    """Rows of ``keys`` whose ``key`` falls into a bucket of more than ``min_count`` rows.

    Each value that occurs so often is in such a bucket, so none of them is lost.
    """
    if not 0 < buckets <= FIELD_BUCKETS_AT_MOST:
        raise ValueError(f"buckets must be between 1 and {FIELD_BUCKETS_AT_MOST}")
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    counts = keys.groupBy(bucket).count().filter(F.col("count") > min_count)
    frequent = materialise(counts.select("bucket"), "frequent-buckets")
    # At most one number for each bucket.
    return keys.select("key", bucket).join(F.broadcast(frequent), "bucket", "left_semi").select("key")


def field_counts(df: DataFrame, field: str, min_count: int = MIN_FIELD_COUNT, buckets: int | None = None) -> DataFrame:
    """Values of a field that occur more than ``min_count`` times: ``key, count, line``.

    ``line`` is the report line: the count right-aligned to six places, a TAB, the
    key. Rows without the field do not count.

    With ``buckets`` the rows are read twice: a first pass counts hash buckets of the values,
    and only values of frequent buckets are counted themselves. The result is the same, but
    rare values are hardly shuffled. It pays for fields of mostly different values, if
    ``buckets`` is several times the rows divided by ``min_count``.
    """
    keys = df.select(F.col(field).cast("string").alias("key")).filter(F.col("key").isNotNull())
    if buckets is not None:
        keys = in_frequent_buckets(keys, min_count, buckets)
    return (
        keys.groupBy("key")
        .count()
        .filter(F.col("count") > min_count)
        .select("key", "count", F.format_string("%6d\t%s", "count", "key").alias("line"))
    )
