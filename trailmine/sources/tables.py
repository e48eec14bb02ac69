"""Results of earlier runs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmine.functions.columns import field, once, tab_fields


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Session rows from TAB text ``session, query, refinement, doc[, count]``.

    Every row counts once, whatever its fifth field says.
    """
    f = F.col("fields")
    return spark.read.text(path).select(once(tab_fields(F.col("value"))).alias("fields")).select(
        field(f, 0).alias("session_id"),
        F.substring_index(field(f, 0), "_", 1).try_cast("bigint").alias("user_id"),
        field(f, 1).alias("query"),
        field(f, 2).alias("refinement"),
        F.coalesce(field(f, 3), F.lit("")).alias("doc"),
        F.lit(1).alias("count"),
    )


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster rows from the ``*.txt`` files of a folder; a malformed number stops the job."""
    f = F.col("fields")
    lines = spark.read.text(path, pathGlobFilter="*.txt")
    return lines.select(once(tab_fields(F.col("value"))).alias("fields")).select(
        field(f, 0).alias("query"),
        field(f, 1).cast("int").alias("cluster_id"),
        field(f, 2).alias("refinement"),
        field(f, 3).cast("bigint").alias("ref_count"),
    )


def bucket_of(query: Column, buckets: int) -> Column:
    """The folder of a query in a suggestion table of so many buckets."""
    number = F.pmod(F.xxhash64(query), F.lit(buckets))
    return F.concat(F.lpad(number.cast("string"), 6, "0"), F.lit(f"-of-{buckets}"))


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the suggestion table at ``path``; None without a table."""
    try:
        row = spark.read.parquet(path).select("bucket").first()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise ValueError(f"{path} is no suggestion table in buckets") from error
        return None
    return int(row["bucket"].rpartition("-")[2]) if row else None


def read_suggestions(spark: SparkSession, path: str, queries: DataFrame | None = None) -> DataFrame:
    """The table written by ``write_suggestions`` or ``replace_suggestions``.

    With ``queries``, only the rows of these. Of a table of ``replace_suggestions`` only the
    folders that can hold one of them are read; their names, no more than there are folders,
    pass the driver.
    """
    table = spark.read.parquet(path)
    if queries is None:
        return table.drop("bucket")
    wanted = queries.select(F.col("query").alias("wanted"))
    if "bucket" in table.columns:
        n = bucket_count(spark, path)
        folders = [r[0] for r in wanted.select(bucket_of(F.col("wanted"), n)).distinct().collect()] if n else []
        table = table.filter(F.col("bucket").isin(folders)).drop("bucket")
    return table.join(wanted, F.col("query") == F.col("wanted"), "left_semi")
