"""Output layouts of the pipeline levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.functions.columns import tab_line
from trailmine.params import SUGGESTION_BUCKETS
from trailmine.sources.tables import bucket_count, bucket_of
from trailmine.storage import materialise

# Columns of each text layout, in output order.
LAYOUTS = {
    "log": ("user_id", "ts_ms", "query", "doc"),
    "user": ("user_id",),
    "session": ("session_id", "query", "refinement", "doc", "count"),
    "general": ("session_id", "query", "refinement", "count"),
    "ref_count": ("query", "refinement", "count"),
    "co_occ": ("query", "refinement", "co_refinement", "count"),
    "cluster": ("query", "cluster_id", "refinement", "ref_count"),
}

# Which layout each pipeline level is written in.
LEVEL_LAYOUT = {
    "logMap": "log",
    "test": "user",
    "sessionConstruction": "session",
    "singleSessions": "session",
    "countRef": "ref_count",
    "topCountRef": "ref_count",
    "cluster": "cluster",
    "": "cluster",
}

# Columns that a frame may lack: the documents of single sessions are written empty, the
# counts of plain clusters left off.
OPTIONAL = {"session": {"doc"}, "cluster": {"ref_count"}}

# Literal prefixes of the refinement count layout.
_PREFIX = {"query": "q: ", "refinement": "r: "}


def _layout_field(layout: str, name: str, present: bool) -> Column:
    if not present:
        return F.lit("")
    if layout == "ref_count" and name in _PREFIX:
        return F.concat(F.lit(_PREFIX[name]), F.col(name))
    return F.col(name)


def level_lines(df: DataFrame, layout: str) -> DataFrame:
    """One ``value`` line per row.

    Of the columns in ``OPTIONAL`` a trailing one that ``df`` lacks is left off, an inner
    one written empty; any other must be there.
    """
    names = list(LAYOUTS[layout])
    lacking = set(names) - set(df.columns) - OPTIONAL.get(layout, set())
    if lacking:
        raise ValueError(f"the layout {layout} needs the columns {sorted(lacking)}")
    if names[-1] not in df.columns:
        names.pop()
    return df.select(
        tab_line(*[_layout_field(layout, n, n in df.columns) for n in names]).alias("value")
    )


def write_level(df: DataFrame, level: str, path: str, fmt: str = "parquet") -> None:
    """Write a level (or a layout by its own name) as parquet or, with ``fmt='text'``, TAB lines.

    The empty name stands for the whole pipeline; an unknown one is refused.
    """
    if level not in LAYOUTS and level not in LEVEL_LAYOUT:
        raise ValueError(f"no level or layout {level!r}; known: {sorted([*LAYOUTS, *LEVEL_LAYOUT])}")
    if fmt == "text":
        layout = level if level in LAYOUTS else LEVEL_LAYOUT[level]
        level_lines(df, layout).write.text(path)
    else:
        df.write.format(fmt).save(path)


def write_field_counts(counts: DataFrame, path: str) -> None:
    """Write the ``line`` column of ``field_counts``."""
    counts.select(F.col("line").alias("value")).write.text(path)


def write_suggestions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace the suggestion table at ``path``, or add to it with ``mode="append"``.

    Every file of one writing holds a range of queries, sorted, so that a lookup reads
    one of them by its statistics.
    """
    df.repartitionByRange("query").sortWithinPartitions("query").write.mode(mode).parquet(path)


def replace_suggestions(df: DataFrame, path: str, buckets: int = SUGGESTION_BUCKETS) -> None:
    """Put the queries of ``df`` into the suggestion table at ``path`` in place of their old rows.

    The table lies in folders, one for each bucket of queries by hash. Only buckets that hold
    one of the queries are read and written again; their other queries are kept. So doing it
    twice leaves the table as doing it once, and a job that failed can be repeated. The first
    writing decides the number of buckets. A query without new rows keeps its old ones. One
    writer at a time may change a table.
    """
    spark = df.sparkSession
    n = bucket_count(spark, path)
    new = df.withColumn("bucket", bucket_of(F.col("query"), n or buckets))
    if n:
        # Written down first, as these folders are replaced below.
        new = materialise(new, "new-suggestions")
        touched = spark.read.parquet(path).join(new.select("bucket").distinct(), "bucket", "left_semi")
        known = new.select(F.col("query").alias("new_query")).distinct()
        kept = touched.join(known, F.col("query").eqNullSafe(F.col("new_query")), "left_anti")
        new = new.unionByName(materialise(kept.select(*new.columns), "kept-suggestions"))
    rows = new.repartition("bucket", "query").sortWithinPartitions("bucket", "query")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
