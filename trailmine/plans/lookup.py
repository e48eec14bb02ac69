"""Suggestions looked up in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trailmine.operators.suggest import suggest, wanted_queries
from trailmine.params import SUGGESTION_LIMIT
from trailmine.sources.tables import read_suggestions
from trailmine.storage import materialise


def look_up(path: str, requests: DataFrame, limit: int = SUGGESTION_LIMIT) -> DataFrame:
    """:func:`suggest` on the suggestion table at ``path``, of which no more is read than needed."""
    # Written down, as the folders, the rows and the ranks are all chosen by it.
    wanted = materialise(wanted_queries(requests), "requests")
    return suggest(read_suggestions(requests.sparkSession, path, wanted), wanted, limit)
