"""Properties of the plans that matter on large data."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR, tuples
from pyspark.sql import functions as F

from trailmine import schemas
from trailmine.operators.cooccurrence import co_occurrences
from trailmine.operators.counts import count_refinements, first_session_refs, top_refinements
from trailmine.operators.sessions import build_sessions, mark_sessions
from trailmine.operators.walk import absorption_vectors, products_of_vectors, steps_of, transition_table, vector_products
from trailmine.plans.adapters import events_as_log
from trailmine.plans.pipeline import Settings, co_occ_of, docs_of, top_of
from trailmine.storage import materialise

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def final_plan(df) -> str:
    """The plan as it ran, after adaptive changes."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def log(spark):
    return events_as_log(spark.read.parquet(f"{SF_DIR}/events.parquet"))


def test_the_log_is_put_in_order_once(log, with_conf):
    """After the ordered pass only records and starts are shuffled, by (user, slot), and nothing is sorted for a window."""
    with_conf(NO_BROADCAST)
    plan = final_plan(build_sessions(log.filter("user_id < 40"), 86_400, blocks=1))
    assert len(re.findall(r"[+:]- Exchange hashpartitioning\(user_id#\d+L, slot#\d+L, \d+\)", plan)) == 2
    assert plan.count("- Exchange ") == 2 and "Window" not in plan
    # Users that a border cuts are read once more, from one more exchange of these users.
    plan = final_plan(build_sessions(log, 86_400, blocks=4))
    assert "Window" not in plan and "rangepartitioning" not in plan
    assert len(re.findall(r"[+:]- Exchange hashpartitioning\(user_id#\d+L, \d+\)", plan)) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_slot_is_split(make_log):
    """One user with 3,000 queries in a slot, at default thresholds: no task has a quarter of the pairs."""
    hot = [(1, 601_000_000 + i, f"q{i}", "") for i in range(3000)]
    marked = mark_sessions(make_log(hot).repartition(4))
    task = marked.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert task[1] == 3000 * 2999 // 2 and task[0] < task[1] / 4


def test_hot_slots_change_no_row(make_log):
    records = [(u, i * 7_000, f"q{i % 5}", "d" if i % 3 else "") for u in (1, 2) for i in range(200)]
    log = make_log(records)
    assert tuples(mark_sessions(log, pairs_per_task=50)) == tuples(mark_sessions(log))


def test_only_needed_columns_of_the_events_are_read(spark):
    log = events_as_log(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    plan = final_plan(log.filter("user_id = 3").groupBy("user_id").count())
    assert "ReadSchema: struct<user_id:bigint>" in plan
    assert re.search(r"PushedFilters: \[.*EqualTo\(user_id,3\)", plan)


def test_top_k_is_cut_before_the_shuffle(spark, log):
    marked = materialise(mark_sessions(log, 86_400), "marked")
    plan = final_plan(top_refinements(count_refinements(first_session_refs(marked)), 5))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    # Counting first rows of a session needs no shuffle by session.
    assert "hashpartitioning(session_id" not in plan
    assert re.search(r"DataFilters: \[.*is_first", plan)


def test_pairs_are_built_without_a_self_join(spark):
    refs = spark.createDataFrame([("1_0", "q", "a", 1)], "session_id string, query string, refinement string, count int")
    plan = final_plan(co_occurrences(refs))
    assert "Join" not in plan and plan.count("- Exchange ") == 1


def test_clicks_are_counted_before_the_join(log, with_conf):
    """A very frequent (query, refinement) is combined on the map side, not in the join task."""
    with_conf(NO_BROADCAST)
    marked = materialise(mark_sessions(log, 86_400), "marked")
    settings = Settings(span_s=86_400)
    plan = final_plan(docs_of(marked, top_of(marked, settings), settings))
    assert re.search(r"hashpartitioning\(query#\d+, refinement#\d+, doc#\d+, \d+\)", plan)
    assert "partial_sum" in plan and "LeftSemi" in plan


def test_document_parts_of_a_query_go_to_several_tasks(spark, log, with_conf):
    with_conf(NO_BROADCAST)
    marked = materialise(mark_sessions(log, 86_400), "marked")
    settings = Settings(span_s=86_400)
    top = top_of(marked, settings)
    co_occ, docs = co_occ_of(marked, top), docs_of(marked, top, settings)
    steps = materialise(transition_table(co_occ, docs), "steps")
    products = vector_products(steps_of(steps, "ref"), steps_of(steps, "doc"), doc_rows_per_task=5)
    plan = final_plan(products)
    assert len(re.findall(r"- Exchange hashpartitioning\(query#\d+, part#\d+L, \d+\)", plan)) == 2


def test_entries_of_vectors_are_never_shuffled_by_document(spark, with_conf):
    """One query with 30 refinements and 400 documents; between stages go matrices, steps and pairs."""
    with_conf(NO_BROADCAST)
    co = [("q", f"r{i}", f"r{i + 1}", 1) for i in range(29)]
    clicks = [("q", f"r{d % 30}", f"d{d}", 1) for d in range(400)]
    steps = materialise(transition_table(spark.createDataFrame(co, schemas.CO_OCC), spark.createDataFrame(clicks, schemas.DOC_COUNTS)), "steps")
    vectors = absorption_vectors(steps)
    plan = final_plan(vectors)
    assert len(re.findall(r"- Exchange hashpartitioning\(query#\d+, part#\d+L, \d+\)", plan)) == 2
    assert "Aggregate" not in plan and not re.search(r"Exchange hashpartitioning\([^)]*refinement", plan)
    products = products_of_vectors(materialise(vectors, "vectors"), rows_per_task=2_000)
    plan = final_plan(products)
    assert "collect_list" not in plan and "Generate" not in plan
    assert products.count() == 30 * 31 // 2


def test_schemas(spark, log):
    assert log.columns == schemas.LOG.fieldNames()
    assert build_sessions(log).columns == schemas.SESSIONS.fieldNames()
    assert [f.dataType for f in build_sessions(log).schema] == [f.dataType for f in schemas.SESSIONS]
