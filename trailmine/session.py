"""A Spark session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it sizes the shuffle partitions, it
# broadcasts a join side once its real size is known to be small, and it splits
# skewed join partitions (a hot user, query or document).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_spark(app_name: str = "trailmine", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a session; ``settings`` override the defaults (``__`` stands for a dot)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = SETTINGS | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in merged.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
