from trailmine.sources.logs import (
    LogFiles,
    parse_log_lines,
    read_log_fields,
    read_log_files,
    read_query_log,
    rejected_lines,
    rejected_rows,
    split_log_fields,
)
from trailmine.sources.tables import read_clusters, read_sessions, read_suggestions

__all__ = [
    "LogFiles",
    "parse_log_lines",
    "read_clusters",
    "read_log_fields",
    "read_log_files",
    "read_query_log",
    "read_sessions",
    "read_suggestions",
    "rejected_lines",
    "rejected_rows",
    "split_log_fields",
]
