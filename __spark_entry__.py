"""Entry points for the check and bench drivers.

``queries()`` runs every operator over the whole ``events`` table seen as a search
log; ``oracle_sql()`` states the expected rows in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from oracle_queries import (  # noqa: E402
    DOC_ROWS_PER_TASK,
    FEW_CLUSTERS,
    LOG_BLOCKS,
    MANY_CLUSTERS,
    REPEAT_BUCKETS,
    SEEDS,
    SKEWED_SPAN_S,
    SPAN_S,
    STREAM_DELAY_S,
    SUGGESTIONS,
    TOP_DOCS,
    TOP_REFS,
    URL_BUCKETS,
    URL_MIN_COUNT,
    USER_MIN_COUNT,
)
from trailmine.operators import (  # noqa: E402
    clustering,
    cooccurrence,
    counts,
    sessions,
    suggest,
    walk,
)
from trailmine.plans import pipeline  # noqa: E402
from trailmine.plans.adapters import events_as_lines, events_as_log  # noqa: E402
from trailmine.plans.lookup import look_up  # noqa: E402
from trailmine.sinks import (  # noqa: E402
    replace_suggestions,
    write_field_counts,
    write_level,
    write_suggestions,
)
from trailmine.sources import (  # noqa: E402
    parse_log_lines,
    read_clusters,
    read_log_fields,
    read_log_files,
    read_query_log,
    read_sessions,
    read_suggestions,
    rejected_lines,
    rejected_rows,
    split_log_fields,
)
from trailmine.streaming.starts import stream_session_starts  # noqa: E402
from trailmine.storage import materialise, materialise_together, scratch_path  # noqa: E402

try:
    from trailmine.llm import queries as llm_queries
except ImportError:  # the library works without the corpus operators
    llm_queries = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

LOG_FILES = 5
SETTINGS = pipeline.Settings(span_s=SPAN_S)
SINGLETONS = pipeline.Settings(span_s=SPAN_S, min_clusters=MANY_CLUSTERS)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_log(_events(spark, sf_dir))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.build_sessions(_log(spark, sf_dir), SPAN_S)


def _marked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session rows for queries that use them more than once."""
    return materialise(pipeline.sessions_of(_log(spark, sf_dir), SETTINGS), "sessions")


def _ref_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_refinements(counts.distinct_session_refs(_sessions(spark, sf_dir)))


def _marked_and_top(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _marked_table(spark, sf_dir)
    return rows, materialise(pipeline.top_of(rows, SETTINGS), "top-refs")


def _count_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows, top = _marked_and_top(spark, sf_dir)
    co_occ, docs = materialise_together(
        {"co-occ": pipeline.co_occ_of(rows, top), "doc-counts": pipeline.docs_of(rows, top, SETTINGS)}
    )
    return co_occ, docs


def _transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps for queries that use them more than once."""
    return materialise(walk.transition_table(*_count_tables(spark, sf_dir)), "transitions")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors for queries that use them more than once."""
    return materialise(walk.absorption_vectors(_transitions(spark, sf_dir)), "vectors")


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 9))


# Logs and fields -----------------------------------------------------------------


def q_parse_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = events_as_lines(_events(spark, sf_dir))
    return parse_log_lines(lines, seq="seq").drop("ts")


def q_sessions_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session starts of a log of several text files; many records have equal seconds."""
    path = scratch_path(spark, "log-files")
    lines = events_as_lines(_events(spark, sf_dir))
    lines.repartitionByRange(LOG_FILES, "seq").sortWithinPartitions("seq").select("value").write.text(path)
    return sessions.session_starts(read_query_log(spark, path), SPAN_S)


def q_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_lines(events_as_lines(_events(spark, sf_dir))).select("value")


def _text_log(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "log-lines")
    events_as_lines(_events(spark, sf_dir)).select("value").write.text(path)
    return path


def q_read_query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_query_log(spark, _text_log(spark, sf_dir))
    return log.select("user_id", "ts_ms", "query", "doc")


def q_read_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(spark, _text_log(spark, sf_dir))


def q_log_files_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines, from the pass that reads the log rows."""
    return read_log_files(spark, _text_log(spark, sf_dir)).rejected


def q_parse_log_lines_bot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user whose number ends in 7 is a bot, by a table of users."""
    events = _events(spark, sf_dir)
    bots = events.filter("user_id % 10 = 7").select("user_id")
    return parse_log_lines(events_as_lines(events), bots, seq="seq").drop("ts")


def q_field_counts_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.field_counts(_events(spark, sf_dir), "event_type")


def q_field_counts_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.field_counts(_log(spark, sf_dir), "user_id", min_count=USER_MIN_COUNT)


def q_field_counts_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_log_fields(events_as_lines(_events(spark, sf_dir)))
    return counts.field_counts(fields, "url", min_count=0)


def q_field_counts_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_log_fields(events_as_lines(_events(spark, sf_dir)))
    return counts.field_counts(fields, "url", URL_MIN_COUNT, buckets=URL_BUCKETS)


def q_field_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = read_log_fields(spark, _text_log(spark, sf_dir))
    path = scratch_path(spark, "field-counts")
    write_field_counts(counts.field_counts(fields, "query", min_count=0), path)
    return spark.read.text(path)


# Sessions ------------------------------------------------------------------------


def _repeat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_log(_events(spark, sf_dir), buckets=REPEAT_BUCKETS)


def q_collapse_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.collapse_repeats(_repeat_log(spark, sf_dir)).drop("ts")


def q_collapse_repeats_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _repeat_log(spark, sf_dir)
    return sessions.collapse_repeats(log, blocks=LOG_BLOCKS).drop("ts")


def q_session_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_starts(_log(spark, sf_dir), SPAN_S)


def q_session_starts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the records that the watermark has passed when all files are read (a stream takes a pattern or a folder)."""
    schema = _events(spark, sf_dir).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(f"{sf_dir}/events*.parquet")
    starts = stream_session_starts(events_as_log(events), SPAN_S, delay=f"{STREAM_DELAY_S} seconds")
    path = scratch_path(spark, "streamed-starts")
    place = scratch_path(spark, "stream")
    starts.writeStream.option("checkpointLocation", place).trigger(availableNow=True).start(path, "parquet", "append").awaitTermination()
    return spark.read.parquet(path)


def q_session_starts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_starts(_log(spark, sf_dir), SPAN_S, blocks=LOG_BLOCKS)


def q_sessions_default_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.build_sessions(_log(spark, sf_dir))


def q_sessions_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.build_sessions(_log(spark, sf_dir), SPAN_S, seed_queries=SEEDS)


def q_sessions_seed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a table of seeds."""
    log = _log(spark, sf_dir)
    return sessions.build_sessions(log, SPAN_S, seed_queries=log.filter(F.col("query").isin(SEEDS)).select("query"))


def q_sessions_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user holds a third of the log."""
    log = _log(spark, sf_dir)
    user = F.when(F.col("seq") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("user_id"))
    return sessions.build_sessions(log.withColumn("user_id", user), SKEWED_SPAN_S)


def q_sessions_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.build_sessions(_log(spark, sf_dir), SPAN_S, strict=True)


def q_sessions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.build_sessions(_log(spark, sf_dir), SPAN_S, blocks=LOG_BLOCKS)


# Counts --------------------------------------------------------------------------


def q_distinct_session_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.distinct_session_refs(_sessions(spark, sf_dir))


def q_first_session_refs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return counts.first_session_refs(sessions.mark_sessions(log, SPAN_S, blocks=LOG_BLOCKS))


def q_top_refinements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_refinements(_ref_counts(spark, sf_dir), TOP_REFS)


def _rows_and_top(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _marked_table(spark, sf_dir)
    refs = counts.count_refinements(counts.first_session_refs(rows))
    return rows, counts.top_refinements(refs, TOP_REFS)


def q_top_ref_session_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, top = _rows_and_top(spark, sf_dir)
    return cooccurrence.filter_by_top_refs(counts.distinct_session_refs(rows), top)


def q_top_ref_click_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, top = _rows_and_top(spark, sf_dir)
    clicks = cooccurrence.filter_by_top_refs(rows, top, clicks_only=True)
    return clicks.select("query", "refinement", "doc", "count")


def q_co_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, top = _rows_and_top(spark, sf_dir)
    return cooccurrence.co_occurrences(cooccurrence.filter_by_top_refs(rows, top))


def q_co_occurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.co_occ_of(*_marked_and_top(spark, sf_dir))


def q_symmetric_co_occ(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.symmetric_co_occ(q_co_occurrence_counts(spark, sf_dir))


def q_doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_docs(_sessions(spark, sf_dir).filter(F.col("doc") != ""))


def q_top_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_docs(q_doc_counts(spark, sf_dir), TOP_DOCS)


def q_top_docs_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_docs(q_doc_counts(spark, sf_dir))


def q_top_docs_uncut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_docs(q_doc_counts(spark, sf_dir), k=None)


# Random walk and clusters ----------------------------------------------------------


def q_cluster_input_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.common_queries(*_count_tables(spark, sf_dir))[0]


def q_cluster_input_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.common_queries(*_count_tables(spark, sf_dir))[1]


def q_row_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = q_doc_counts(spark, sf_dir)
    return _rounded(walk.row_normalise(docs, ["query", "refinement"], "count"), "p")


def q_transition_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk.transition_table(*_count_tables(spark, sf_dir)), "p")


def q_absorption_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk.absorption_vectors(_transitions(spark, sf_dir)), "p")


def q_ref_similarity_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk.ref_similarity(_vectors(spark, sf_dir), "max_product"), "similarity")


def q_ref_similarity_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(walk.ref_similarity(_vectors(spark, sf_dir), "cosine"), "similarity")


def _fused_similarity(mode: str, doc_rows_per_task: int = walk.DOC_ROWS_PER_TASK) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        steps = _transitions(spark, sf_dir)
        to_refs, to_docs = walk.steps_of(steps, "ref"), walk.steps_of(steps, "doc")
        products = walk.vector_products(to_refs, to_docs, doc_rows_per_task=doc_rows_per_task)
        table = materialise(products, "products")
        return _rounded(walk.similarity_from_products(table, mode), "similarity")

    return run


def q_cluster_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustering from the operators one by one."""
    transitions = _transitions(spark, sf_dir)
    vectors = materialise(walk.absorption_vectors(transitions), "vectors")
    similarity = walk.ref_similarity(vectors)
    refs = transitions.filter(F.col("kind") == "topic").select(
        "query", F.col("src").alias("refinement")
    )
    return clustering.cluster_refinements(similarity, refs)


def q_clusters_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.cluster_pipeline(_log(spark, sf_dir), SINGLETONS)


def q_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.cluster_pipeline(_log(spark, sf_dir), SETTINGS)


def q_clusters_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = pipeline.Settings(span_s=SPAN_S, doc_rows_per_task=DOC_ROWS_PER_TASK)
    return pipeline.cluster_pipeline(_log(spark, sf_dir), settings)


def q_clusters_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = pipeline.Settings(span_s=SPAN_S, mode="cosine", docs_per_ref=TOP_DOCS)
    return pipeline.cluster_pipeline(_log(spark, sf_dir), settings)


def q_clusters_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters where the counts of co-occurrences differ by up to six orders of magnitude."""
    co_occ, docs = _count_tables(spark, sf_dir)
    digit = lambda c: F.substring(c, -1, 1).cast("int")
    power = F.pow(F.lit(10), (digit("refinement") + digit("co_refinement")) % 7)
    uneven = materialise(co_occ.withColumn("count", (F.col("count") * power).cast("bigint")), "uneven")
    settings = pipeline.Settings(span_s=SPAN_S, min_clusters=FEW_CLUSTERS)
    return pipeline.clusters_of_counts(uneven, docs, settings)


# Suggestions -----------------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query with a click is asked for, with stray blanks, once per event."""
    log = _log(spark, sf_dir).filter(F.col("doc") != "")
    return log.select(F.concat(F.lit(" "), "query", F.lit(" ")).alias("query"))


def q_suggestion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = q_clusters(spark, sf_dir)
    return suggest.suggest(clusters, _requests(spark, sf_dir), limit=SUGGESTIONS)


def q_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = suggest.nest_suggestions(q_suggestion_rows(spark, sf_dir))
    groups = F.transform("suggestions", lambda g: F.array_join(g, ","))
    return nested.select("query", F.array_join(groups, ";").alias("suggestions"))


def q_suggestion_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = suggest.nest_suggestions(q_suggestion_rows(spark, sf_dir))
    lines = suggest.headline_suggestions(nested)
    return lines.withColumn("others", F.array_join("others", ","))


# Levels written and read back --------------------------------------------------------


def _level_text(level: str, settings: pipeline.Settings = SETTINGS) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "level")
        write_level(pipeline.run_level(_log(spark, sf_dir), level, settings), level, path, "text")
        return spark.read.text(path)

    return run


def _layout_text(layout: str, rows: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "layout")
        write_level(rows(spark, sf_dir), layout, path, "text")
        return spark.read.text(path)

    return run


def q_roundtrip_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sessions-text")
    write_level(_sessions(spark, sf_dir), "sessionConstruction", path, "text")
    return read_sessions(spark, path)


def q_roundtrip_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clusters-text")
    write_level(q_clusters_singletons(spark, sf_dir), "", path, "text")
    return read_clusters(spark, path)


def q_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "top-refs-parquet")
    write_level(pipeline.run_level(_log(spark, sf_dir), "topCountRef", SETTINGS), "topCountRef", path)
    return spark.read.parquet(path)


def q_roundtrip_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "suggestions")
    write_suggestions(q_clusters_singletons(spark, sf_dir), path)
    return read_suggestions(spark, path)


def q_suggestions_in_two_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suggestion table to which a second run adds its rows."""
    path = scratch_path(spark, "suggestions")
    clusters = materialise(q_clusters_singletons(spark, sf_dir), "clusters")
    write_suggestions(clusters.filter("cluster_id % 2 = 0"), path)
    write_suggestions(clusters.filter("cluster_id % 2 = 1"), path, mode="append")
    return read_suggestions(spark, path)


def q_suggestions_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best rows of each requested query, from a written table."""
    path = scratch_path(spark, "suggestions")
    replace_suggestions(q_clusters(spark, sf_dir), path)
    return look_up(path, _requests(spark, sf_dir), SUGGESTIONS)


def q_suggestions_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suggestion table in which a second run, done twice, replaces the rows of some queries."""
    path = scratch_path(spark, "suggestions")
    clusters = materialise(q_clusters_singletons(spark, sf_dir), "clusters")
    replace_suggestions(clusters, path)
    again = clusters.filter(F.col("query").startswith("click")).withColumn("ref_count", F.col("ref_count") * 10)
    for _ in range(2):
        replace_suggestions(again, path)
    return read_suggestions(spark, path)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """The whole chain: log, sessions, refinements, random walk, clusters with counts."""
    return q_clusters(spark, sf_dir)


def queries() -> dict[str, Query]:
    found = _own_queries()
    if llm_queries:
        found |= llm_queries.queries()
    if llm_queries and corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def _own_queries() -> dict[str, Query]:
    return {
        "parse_log_lines": q_parse_log_lines,
        "rejected_rows": q_rejected_rows,
        "read_query_log": q_read_query_log,
        "read_rejected_rows": q_read_rejected_rows,
        "log_files_rejected": q_log_files_rejected,
        "parse_log_lines_bot_table": q_parse_log_lines_bot_table,
        "field_counts_event_type": q_field_counts_event_type,
        "field_counts_user": q_field_counts_user,
        "field_counts_url": q_field_counts_url,
        "field_counts_frequent": q_field_counts_frequent,
        "field_count_report": q_field_count_report,
        "sessions_of_files": q_sessions_of_files,
        "collapse_repeats": q_collapse_repeats,
        "collapse_repeats_split": q_collapse_repeats_split,
        "session_starts": q_session_starts,
        "session_starts_split": q_session_starts_split,
        "session_starts_stream": q_session_starts_stream,
        "sessions": _sessions,
        "sessions_default_span": q_sessions_default_span,
        "sessions_seeded": q_sessions_seeded,
        "sessions_seed_table": q_sessions_seed_table,
        "sessions_skewed": q_sessions_skewed,
        "sessions_strict": q_sessions_strict,
        "sessions_split": q_sessions_split,
        "distinct_session_refs": q_distinct_session_refs,
        "first_session_refs_split": q_first_session_refs_split,
        "refinement_counts": _ref_counts,
        "top_refinements": q_top_refinements,
        "top_ref_session_rows": q_top_ref_session_rows,
        "top_ref_click_rows": q_top_ref_click_rows,
        "co_occurrences": q_co_occurrences,
        "co_occurrence_counts": q_co_occurrence_counts,
        "symmetric_co_occ": q_symmetric_co_occ,
        "doc_counts": q_doc_counts,
        "top_docs": q_top_docs,
        "top_docs_default": q_top_docs_default,
        "top_docs_uncut": q_top_docs_uncut,
        "cluster_input_pairs": q_cluster_input_pairs,
        "cluster_input_docs": q_cluster_input_docs,
        "row_normalise": q_row_normalise,
        "transition_table": q_transition_table,
        "absorption_vectors": q_absorption_vectors,
        "ref_similarity_max": q_ref_similarity_max,
        "ref_similarity_cosine": q_ref_similarity_cosine,
        "fused_similarity_max": _fused_similarity("max_product"),
        "fused_similarity_cosine": _fused_similarity("cosine", DOC_ROWS_PER_TASK),
        "cluster_ids": q_cluster_ids,
        "clusters_singletons": q_clusters_singletons,
        "clusters": q_clusters,
        "clusters_in_parts": q_clusters_in_parts,
        "clusters_cosine": q_clusters_cosine,
        "clusters_uneven": q_clusters_uneven,
        "suggestion_rows": q_suggestion_rows,
        "suggestions": q_suggestions,
        "suggestion_headlines": q_suggestion_headlines,
        "level_log_map": _level_text("logMap"),
        "level_test": _level_text("test"),
        "level_session_construction": _level_text("sessionConstruction"),
        "level_single_sessions": _level_text("singleSessions"),
        "level_count_ref": _level_text("countRef"),
        "level_top_count_ref": _level_text("topCountRef"),
        "level_cluster": _level_text("cluster"),
        "level_whole": _level_text(""),
        "layout_co_occ": _layout_text("co_occ", q_co_occurrence_counts),
        "layout_general": _layout_text("general", _sessions),
        "roundtrip_sessions": q_roundtrip_sessions,
        "roundtrip_clusters": q_roundtrip_clusters,
        "roundtrip_parquet": q_roundtrip_parquet,
        "roundtrip_suggestions": q_roundtrip_suggestions,
        "suggestions_in_two_steps": q_suggestions_in_two_steps,
        "suggestions_replaced": q_suggestions_replaced,
        "suggestions_looked_up": q_suggestions_looked_up,
    }


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.all_queries()
    if llm_queries:
        found |= llm_queries.oracle_sql()
    if llm_queries and corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
