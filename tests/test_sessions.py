from __future__ import annotations

import random
import time

import pytest
import twin
from conftest import tuples
from pyspark.sql import functions as F

from trailmine.operators import scan
from trailmine.operators.counts import distinct_session_refs, first_session_refs
from trailmine.operators.sessions import (
    build_sessions,
    collapse_repeats,
    deal,
    expiry_ms,
    hot_slots,
    mark_sessions,
    session_starts,
)

WORKED = [
    (7, 0, "term1", ""),
    (7, 76_000, "term2", ""),
    (7, 76_000, "term2", ""),
    (7, 123_000, "term3", ""),
    (7, 123_000, "term4", ""),
    (7, 162_000, "term5", "D"),
    (7, 162_000, "term5", "D"),
]


def row_columns(df):
    return tuples(df, "session_id", "user_id", "query", "refinement", "doc")


def random_log(seed, users=6, per_user=80, step_s=400, queries="abcd", bulk=0):
    """Records with equal times, empty queries, repeats and gaps around the span."""
    rng = random.Random(seed)
    records = []
    for user in range(users):
        ms = rng.randrange(-5_000_000, 5_000_000)
        for _ in range(per_user + (bulk if user == 0 else 0)):
            ms += rng.choice([0, 0, 1, 999, 1000, 60_000, 600_000, 600_999, 601_000, step_s * 1000])
            query = rng.choice(list(queries) + [""])
            records.append((user, ms, query, rng.choice(["", "", "x", "y"])))
    rng.shuffle(records)
    return records


def test_worked_example(make_log):
    rows = tuples(build_sessions(make_log(WORKED)), "query", "refinement", "doc")
    names = ["term1", "term2", "term3", "term4", "term5"]
    doc = {"term5": "D"}
    assert rows == sorted(
        (a, b, doc.get(b, "")) for i, a in enumerate(names) for b in names[i + 1 :]
    )


def test_repeats_are_collapsed_however_late(make_log):
    log = make_log([(1, 0, "a", ""), (1, 10**9, "a", ""), (1, 10**9 + 1, "a", "d"), (2, 0, "", "")])
    assert tuples(collapse_repeats(log), "user_id", "query", "doc") == [(1, "a", ""), (1, "a", "d")]


@pytest.mark.parametrize("last, inside", [(600_999, True), (601_000, False)])
def test_span_limit(make_log, last, inside):
    log = make_log([(1, 0, "a", ""), (1, last, "b", "")])
    assert tuples(build_sessions(log), "refinement") == ([("b",)] if inside else [])


def test_expired_session_is_not_reopened_inside_a_run(make_log):
    log = make_log([(1, 0, "a", ""), (1, 700_000, "a", "d"), (1, 800_000, "b", "")])
    assert tuples(session_starts(log), "query", "ts_ms") == [("a", 0), ("b", 800_000)]
    assert build_sessions(log).count() == 0


def test_reopened_after_another_query(make_log):
    log = make_log([(1, 0, "a", ""), (1, 650_000, "b", ""), (1, 700_000, "a", ""), (1, 710_000, "b", "")])
    starts = tuples(session_starts(log), "query", "ts_ms")
    assert starts == [("a", 0), ("a", 700_000), ("b", 650_000)]
    assert tuples(build_sessions(log), "query", "refinement") == [("a", "b"), ("b", "a")]


def test_seed_queries(make_log):
    rows = build_sessions(make_log(WORKED), seed_queries=["term4"])
    assert tuples(rows, "query", "refinement") == [("term4", "term5")]


def test_strict_drops_single_refinements_without_document(make_log):
    log = make_log([(1, 0, "a", ""), (1, 1, "b", ""), (2, 0, "a", ""), (2, 1, "b", "d")])
    assert tuples(build_sessions(log), "user_id", "query") == [(1, "a"), (2, "a")]
    assert tuples(build_sessions(log, strict=True), "user_id", "query") == [(2, "a")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_logs_agree_with_the_twin(make_log, seed):
    records = random_log(seed)
    log = make_log(records).repartition(3)
    assert row_columns(build_sessions(log)) == twin.session_rows(records)
    expected = sorted(twin.sessions(records))
    assert tuples(session_starts(log), "user_id", "query", "ts_ms", "seq") == expected


@pytest.mark.parametrize("seed, blocks, batch", [(4, 25, 10_000), (5, 8, 7), (6, 60, 3)])
def test_blocks_and_batches_agree_with_the_twin(make_log, with_conf, seed, blocks, batch):
    # One user holds most of the log; blocks are cut inside users and equal times.
    with_conf({"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)})
    records = random_log(seed, users=4, bulk=700)
    marked = mark_sessions(make_log(records), blocks=blocks)
    assert row_columns(marked) == twin.session_rows(records)
    assert tuples(first_session_refs(marked)) == tuples(distinct_session_refs(marked))
    log = make_log(records).repartition(3)
    assert tuples(session_starts(log, blocks=blocks), "user_id", "query", "ts_ms", "seq") == sorted(twin.sessions(records))
    assert tuples(collapse_repeats(log, blocks)) == tuples(collapse_repeats(log, 1))
    seeded = tuples(session_starts(log, seed_queries=["a", "c"], blocks=blocks))
    assert seeded == tuples(session_starts(log, seed_queries=["a", "c"], blocks=1)) and seeded
    table = log.select("query").filter("query in ('a', 'c')").unionByName(log.selectExpr("'unknown' as query").limit(1))
    assert seeded == tuples(session_starts(log, seed_queries=table, blocks=blocks))
    rows = tuples(build_sessions(log, seed_queries=["a", "c"], blocks=blocks))
    assert rows == tuples(build_sessions(log, seed_queries=table, blocks=blocks)) and rows


def test_what_came_before_a_record(make_log):
    records = random_log(8, users=3, per_user=50)
    got = {r["seq"]: r for r in scan.pass_log(make_log(records), expiry_ms(600), blocks=20).records.collect()}
    before, places = {}, {}
    for seq, (user, ms, query, doc) in sorted(enumerate(records), key=lambda r: (r[1][0], r[1][1], r[0])):
        row = got[seq]
        assert (row["prev_query"], row["prev_doc"]) == before.get(user, ("", ""))
        assert (row["same_ms"], row["same_seq"]) == places.get((user, query), (None, None))
        before[user], places[user, query] = (query, doc), (ms, seq)


def test_null_users_and_queries(spark, make_log):
    log = make_log([(1, 0, "a", ""), (1, 1, "b", "d")])
    odd = spark.createDataFrame([(u, None, ms, ms + 10, q, d) for u, ms, q, d in (
        (None, 0, "a", ""), (None, 1, "a", ""), (None, 2, None, "x"), (None, 3, None, "x"), (2, 5, None, ""), (2, 6, "b", None))], log.schema)
    for blocks in (1, 6):
        rows = tuples(collapse_repeats(log.unionByName(odd), blocks), "seq")
        assert rows == [(0,), (1,), (10,), (12,), (15,), (16,)]
        assert tuples(build_sessions(log.unionByName(odd), blocks=blocks), "query", "refinement") == [("a", "b")]
    assert build_sessions(log.limit(0)).count() == 0 and session_starts(log.limit(0)).count() == 0


def test_a_slot_of_many_records_and_few_starts(spark):
    """The pairs are dealt by rows times starts, so that records are copied a few times at most."""
    rows = spark.range(40_000).select(
        F.lit(1).cast("long").alias("user_id"), F.lit(None).cast("timestamp").alias("ts"), F.col("id").alias("ts_ms"), F.col("id").alias("seq"),
        F.concat(F.lit("q"), (F.col("id") % 4).cast("string")).alias("query"), F.lit("").alias("doc"))
    mark_sessions(rows.limit(100)).count()
    begin = time.perf_counter()
    assert mark_sessions(rows).count() == 4 * 30_000 - 6
    assert time.perf_counter() - begin < 10


def test_copies_of_dealt_rows(spark):
    slots = spark.createDataFrame([(1, 0, 100_000, 4), (2, 0, 50_000, 50_000), (3, 5, 10, 10), (4, 0, 3_000_000, 2)],
                                  "user_id long, slot long, n_rows int, n_starts int")
    hot = hot_slots(slots, 500_000)
    parts = {(r["user_id"], r["slot"]): (r["row_parts"], r["start_parts"]) for r in hot.collect()}
    # 400,000 pairs stay together; of many starts both sides are cut alike; few starts are copied instead of rows.
    assert set(parts) == {(2, 0), (4, 0)}
    assert parts[4, 0] == (12, 1) and parts[2, 0][0] == parts[2, 0][1] == 71
    record = spark.range(1000).select(F.lit(4).cast("long").alias("user_id"), F.lit(0).cast("long").alias("slot"), "id")
    dealt = deal(record, hot, "row_parts", "start_parts", F.xxhash64("id"), 8)
    assert dealt.count() == 1000 and dealt.rdd.getNumPartitions() == 8
    assert deal(record, hot, "start_parts", "row_parts", F.xxhash64("id"), 8).count() == 12_000


def test_long_open_chains_across_blocks(make_log):
    # Two queries alternate without a gap for many blocks of one user.
    rng = random.Random(9)
    ms, records = 0, []
    for i in range(3000):
        ms += rng.randrange(1, 60_000)
        records.append((1, ms, "ab"[i % 2], ""))
    log = make_log(records)
    starts = tuples(session_starts(log, blocks=6), "user_id", "query", "ts_ms", "seq")
    assert starts == sorted(twin.sessions(records))
    assert len(starts) > 150


def test_many_records_at_one_time(make_log):
    records = [(1, 5_000, "abc"[i % 3], "") for i in range(300)]
    log = make_log(records)
    for blocks in (7, 1):
        starts = tuples(session_starts(log, blocks=blocks), "query", "ts_ms", "seq")
        assert starts == [("a", 5_000, 0), ("b", 5_000, 1), ("c", 5_000, 2)]


def test_many_starts_of_one_pair_take_linear_time(spark):
    def seconds(n):
        ms = F.col("id") * 700_000
        rows = spark.range(2 * n).select(
            F.lit(1).cast("long").alias("user_id"), F.lit(None).cast("timestamp").alias("ts"), ms.alias("ts_ms"),
            F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("query"), F.lit("").alias("doc"))
        begin = time.perf_counter()
        assert session_starts(rows).count() == 2 * n
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(40_000) < 6


def test_first_rows_equal_the_distinct_refinements(make_log):
    marked = mark_sessions(make_log(random_log(11)))
    assert tuples(first_session_refs(marked)) == tuples(distinct_session_refs(marked))
