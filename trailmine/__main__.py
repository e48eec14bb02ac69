"""The two jobs: ``python -m trailmine cluster IN OUT [LEVEL]`` and ``... field-counts IN OUT [FIELD]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from trailmine.operators.counts import field_counts
from trailmine.params import BOT_USERS, MIN_CLUSTERS, MIN_FIELD_COUNT, SESSION_SPAN_S, TOP_REFINEMENTS
from trailmine.plans.pipeline import Settings, run_level
from trailmine.session import build_spark
from trailmine.sinks import write_field_counts, write_level
from trailmine.sinks.text import LEVEL_LAYOUT
from trailmine.sources import read_log_fields, read_query_log
from trailmine.storage import scratch_scope

FIELDS = ("user_id", "query", "time", "rank", "url")


def _arguments(args: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trailmine", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    cluster = jobs.add_parser("cluster", help="sessions, refinements and clusters of a query log")
    cluster.add_argument("input")
    cluster.add_argument("output")
    cluster.add_argument("level", nargs="?", default="", help=f"one of {sorted(LEVEL_LAYOUT)}; any other runs the whole pipeline")
    cluster.add_argument("--format", default="text", help="text or a format that Spark writes")
    cluster.add_argument("--span", type=int, default=SESSION_SPAN_S, help="seconds of a session")
    cluster.add_argument("--refs-per-query", type=int, default=TOP_REFINEMENTS)
    cluster.add_argument("--docs-per-ref", type=int, default=None, help="all by default")
    cluster.add_argument("--min-clusters", type=int, default=MIN_CLUSTERS)
    cluster.add_argument("--bots", help="text files with a user number in each line, in place of the known bots")
    cluster.add_argument("--seeds", help="text files with a query in each line; only these open sessions")
    counts = jobs.add_parser("field-counts", help="frequent values of a field")
    counts.add_argument("input")
    counts.add_argument("output")
    counts.add_argument("field", nargs="?", default="0", help=f"a name of {FIELDS} or its number")
    counts.add_argument("--min-count", type=int, default=MIN_FIELD_COUNT)
    counts.add_argument("--buckets", type=int, help="count hash buckets first, for fields of mostly different values")
    return parser.parse_args(args)


def main(args: Sequence[str] | None = None) -> None:
    asked = _arguments(args)
    spark = build_spark(f"trailmine-{asked.job}")
    with scratch_scope(spark):
        if asked.job == "cluster":
            level = asked.level if asked.level in LEVEL_LAYOUT else ""
            bots = spark.read.text(asked.bots).selectExpr("try_cast(trim(value) as bigint) as user_id") if asked.bots else BOT_USERS
            seeds = spark.read.text(asked.seeds).withColumnRenamed("value", "query") if asked.seeds else None
            settings = Settings(
                span_s=asked.span, seed_queries=seeds, refs_per_query=asked.refs_per_query,
                docs_per_ref=asked.docs_per_ref, min_clusters=asked.min_clusters)
            log = read_query_log(spark, asked.input, bots)
            write_level(run_level(log, level, settings), level, asked.output, asked.format)
        else:
            field = FIELDS[int(asked.field)] if asked.field.isdigit() else asked.field
            fields = read_log_fields(spark, asked.input)
            write_field_counts(field_counts(fields, field, asked.min_count, asked.buckets), asked.output)


if __name__ == "__main__":
    main()
