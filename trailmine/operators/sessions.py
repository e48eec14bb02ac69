"""Query sessions: anchored at their first record, a fixed span long, per user.

Order inside a user is ``(ts_ms, seq)``. One ordered pass over the log
(:mod:`trailmine.operators.scan`) tells what came before each record and which records open a
session; a join inside users and slots of time then finds the refinements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.functions.columns import floor_div, whole_seconds_between
from trailmine.operators.scan import Passed, pass_log
from trailmine.params import CELLS_AT_MOST, PAIRS_PER_TASK, SESSION_SPAN_S
from trailmine.storage import materialise


def expiry_ms(span_s: int) -> int:
    """Distance from its start at which a session is closed.

    The age is compared in whole seconds and may equal the span, so 600.999 s is
    still inside a span of 600 s.
    """
    return (span_s + 1) * 1000


def _passed(
    log: DataFrame, span_s: int, seed_queries: Sequence[str] | DataFrame | None = None, blocks: int | None = None
) -> Passed:
    log = log.select("user_id", "ts", "ts_ms", "seq", "query", "doc")
    return pass_log(log, expiry_ms(span_s), seed_queries, blocks)


def _without_repeats(trail: DataFrame) -> DataFrame:
    previous = F.struct(F.col("prev_query").alias("query"), F.col("prev_doc").alias("doc"))
    return trail.filter(F.struct("query", "doc") != previous)


def collapse_repeats(log: DataFrame, blocks: int | None = None) -> DataFrame:
    """Drop a record that has the query and document of the user's previous record."""
    return _without_repeats(_passed(log, SESSION_SPAN_S, blocks=blocks).records).select(*log.columns)


def session_starts(
    log: DataFrame,
    span_s: int = SESSION_SPAN_S,
    seed_queries: Sequence[str] | DataFrame | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Records that open a session: ``user_id, query, ts_ms, seq``.

    A record opens one if the user's previous record had another query and no
    session of its query is open. ``seed_queries`` limits the queries that may: a few names,
    or a table with the column ``query``.
    A start without refinements is listed too. ``blocks`` is the number of blocks in
    which the log is read; it changes no result.
    """
    return _passed(log, span_s, seed_queries, blocks).starts


def hot_slots(slots: DataFrame, pairs_per_task: int) -> DataFrame | None:
    """``user_id, slot, row_parts, start_parts`` of the slots of more pairs than one task should make.

    The pairs of a slot, its rows times the starts of itself and the slot before, are cut
    on a grid, with as few copies as possible: a row is copied once for each part of the
    starts, a start once for each part of the rows. None if there are no such slots.
    """
    met = slots.select("user_id", "slot", "n_rows", "n_starts").unionByName(
        slots.select("user_id", F.col("slot") + 1, F.lit(0).cast("int"), "n_starts").toDF("user_id", "slot", "n_rows", "n_starts"))
    counts = met.groupBy("user_id", "slot").agg(
        F.sum("n_rows").cast("double").alias("rows"), F.sum("n_starts").cast("double").alias("starts"))
    cells = F.ceil(F.col("rows") * F.col("starts") / pairs_per_task)
    start_parts = F.least(F.greatest(F.round(F.sqrt(cells * F.col("starts") / F.col("rows"))), F.lit(1)), F.col("starts"))
    hot = counts.filter(F.col("rows") * F.col("starts") > pairs_per_task).withColumn("start_parts", start_parts.cast("bigint"))
    row_parts = F.least(F.ceil(cells / F.col("start_parts")), F.col("rows"))
    hot = hot.select("user_id", "slot", row_parts.cast("bigint").alias("row_parts"), "start_parts")
    return None if hot.isEmpty() else materialise(hot, "hot-slots")


def deal(rows: DataFrame, hot: DataFrame, own: str, other: str, key: Column, n: int) -> DataFrame:
    """Rows of hot slots, each in one of the ``own`` parts of its slot and copied to all ``other`` parts."""
    keys = ["user_id", "slot"]
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
    dealt = rows.join(hot, keys).withColumns({f"{own}_no": F.pmod(key, F.col(own)), f"{other}_no": every})
    # By number, as these few bytes would otherwise be joined to one task again.
    return dealt.drop(own, other).repartition(n, *keys, "row_parts_no", "start_parts_no")


def _attach_refinements(
    rows: DataFrame, starts: DataFrame, span_s: int, hot: DataFrame | None
) -> DataFrame:
    """Join starts to the later records of the user inside the span.

    The span covers at most two slots of its own length, so an equi-join on
    (user, slot) finds all partners. The pairs of a ``hot`` slot are dealt on a grid.
    """
    expiry = expiry_ms(span_s)
    slot = floor_div(F.col("ts_ms"), expiry)
    records = rows.select(
        "user_id",
        slot.alias("slot"),
        "ts_ms",
        "seq",
        F.col("query").alias("refinement"),
        "doc",
        "same_ms",
        "same_seq",
    )
    openings = starts.select(
        "user_id",
        F.explode(F.array(slot, slot + 1)).alias("slot"),
        F.col("ts_ms").alias("start_ms"),
        F.col("seq").alias("start_seq"),
        "query",
    )
    keys = ["user_id", "slot"]
    if hot is None:
        pairs = records.join(openings, keys)
    else:
        # Cells beyond this number share partitions.
        n = min(hot.agg(F.sum(F.col("row_parts") * F.col("start_parts"))).first()[0], CELLS_AT_MOST)
        cold = records.join(hot, keys, "left_anti").join(openings, keys)
        record_key, start_key = F.xxhash64("ts_ms", "seq"), F.xxhash64("start_seq", "query")
        grid = [*keys, "row_parts_no", "start_parts_no"]
        dealt = deal(records, hot, "row_parts", "start_parts", record_key, n).join(
            deal(openings, hot, "start_parts", "row_parts", start_key, n), grid)
        pairs = cold.unionByName(dealt.drop(*grid[2:]))

    def after_start(ms: str, seq: str) -> Column:
        return (F.col(ms) > F.col("start_ms")) | (
            (F.col(ms) == F.col("start_ms")) & (F.col(seq) > F.col("start_seq"))
        )

    later = after_start("ts_ms", "seq")
    # The refinement is new to the session if its previous record is not inside.
    is_first = F.col("same_ms").isNull() | ~after_start("same_ms", "same_seq")
    inside = whole_seconds_between(F.col("start_ms"), F.col("ts_ms")) <= span_s
    other_query = F.col("refinement") != F.col("query")
    return (
        pairs.filter(later & inside & other_query)
        .select(
            # The record that opens a session is unique in its user, so it names the session.
            F.concat_ws("_", "user_id", "start_seq").alias("session_id"),
            "user_id",
            "query",
            "refinement",
            "doc",
            F.lit(1).alias("count"),
            is_first.alias("is_first"),
        )
    )


def drop_single_unclicked(sessions: DataFrame) -> DataFrame:
    """Drop sessions whose only row has no document."""
    invalid = (
        sessions.groupBy("session_id")
        .agg(F.count("*").alias("n"), F.max("doc").alias("doc"))
        .filter((F.col("n") == 1) & (F.col("doc") == ""))
        .select("session_id")
    )
    return sessions.join(invalid, "session_id", "left_anti")


def mark_sessions(
    log: DataFrame,
    span_s: int = SESSION_SPAN_S,
    seed_queries: Sequence[str] | DataFrame | None = None,
    strict: bool = False,
    blocks: int | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """The rows of :func:`build_sessions` with ``is_first``.

    It marks the first row of each refinement in its session, which makes the
    distinct refinements of all sessions a filter instead of a shuffle.
    """
    passed = _passed(log.filter(F.col("user_id").isNotNull()), span_s, seed_queries, blocks)
    hot = hot_slots(passed.slots, pairs_per_task)
    sessions = _attach_refinements(_without_repeats(passed.records), passed.starts, span_s, hot)
    return drop_single_unclicked(sessions) if strict else sessions


def build_sessions(
    log: DataFrame,
    span_s: int = SESSION_SPAN_S,
    seed_queries: Sequence[str] | DataFrame | None = None,
    strict: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Session rows: each later record with another query inside the span of a start.

    A session needs at least one refinement. ``strict`` also drops sessions of a
    single refinement without a document.
    """
    return mark_sessions(log, span_s, seed_queries, strict, blocks).drop("is_first")
