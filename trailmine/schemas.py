"""Column layout of every stage."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LOG = _schema("user_id BIGINT, ts TIMESTAMP, ts_ms BIGINT, seq BIGINT, query STRING, doc STRING")
STARTS = _schema("user_id BIGINT, query STRING, ts_ms BIGINT, seq BIGINT")
SESSIONS = _schema(
    "session_id STRING, user_id BIGINT, query STRING, refinement STRING, doc STRING, count INT"
)
REF_COUNTS = _schema("query STRING, refinement STRING, count BIGINT")
CO_OCC = _schema("query STRING, refinement STRING, co_refinement STRING, count BIGINT")
DOC_COUNTS = _schema("query STRING, refinement STRING, doc STRING, count BIGINT")
TRANSITIONS = _schema("query STRING, src STRING, dst STRING, kind STRING, p DOUBLE")
VECTORS = _schema("query STRING, refinement STRING, doc STRING, p DOUBLE")
SIMILARITY = _schema("query STRING, refinement STRING, co_refinement STRING, similarity DOUBLE")
CLUSTER_IDS = _schema("query STRING, cluster_id INT, refinement STRING")
CLUSTERS = _schema("query STRING, cluster_id INT, refinement STRING, ref_count BIGINT")
