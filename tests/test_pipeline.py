from __future__ import annotations

import pytest
from conftest import SF_DIR, tuples

from trailmine import storage
from trailmine.operators.counts import distinct_session_refs
from trailmine.plans.adapters import events_as_log
from trailmine.plans.pipeline import Settings, cluster_pipeline, co_occ_of, docs_of, run_level, sessions_of, top_of
from trailmine.sinks import level_lines, write_level
from trailmine.sources import read_clusters, read_sessions
from trailmine.storage import materialise

DAY = 86_400
WORKED = [
    (7, 0, "term1", ""),
    (7, 76_000, "term2", ""),
    (7, 76_000, "term2", ""),
    (7, 123_000, "term3", ""),
    (7, 123_000, "term4", ""),
    (7, 162_000, "term5", "D"),
    (7, 162_000, "term5", "D"),
]


def lines(df, layout):
    return sorted(r.value for r in level_lines(df, layout).collect())


@pytest.fixture(scope="module")
def events(spark):
    return events_as_log(spark.read.parquet(f"{SF_DIR}/events.parquet"))


def members(clusters):
    groups = {}
    for query, cluster, refinement in tuples(clusters, "query", "cluster_id", "refinement"):
        groups.setdefault(query, {}).setdefault(cluster, []).append(refinement)
    return {query: sorted(own.values()) for query, own in groups.items()}


def test_worked_example_at_every_level(make_log):
    log = make_log(WORKED)
    assert lines(run_level(log, "logMap"), "log")[0] == "7\t0\tterm1\t"
    assert lines(run_level(log, "test"), "user") == ["7"] * 7
    assert "7_0\tterm1\tterm5\tD\t1" in lines(run_level(log, "sessionConstruction"), "session")
    assert "7_0\tterm1\tterm5\t\t1" in lines(run_level(log, "singleSessions"), "session")
    refs = lines(run_level(log, "countRef"), "ref_count")
    assert len(refs) == 10 and refs[0] == "q: term1\tr: term2\t1"
    assert lines(run_level(log, "topCountRef"), "ref_count") == refs
    plain = lines(run_level(log, "cluster"), "cluster")
    assert len(plain) == 9 and plain[0] == "term1\t0\tterm2"
    whole = lines(run_level(log), "cluster")
    assert whole == [f"{line}\t1" for line in plain]


def test_events_merge_to_the_minimum(events):
    clusters = cluster_pipeline(events, Settings(span_s=DAY))
    groups = members(clusters)
    assert len(groups) == 50
    for own in groups.values():
        refs = [r for group in own for r in group]
        assert len(refs) == len(set(refs))
        assert len(own) == min(len(refs), 20)


def test_parts_and_blocks_change_nothing(events):
    expected = tuples(cluster_pipeline(events, Settings(span_s=DAY)))
    changed = Settings(span_s=DAY, doc_rows_per_task=15, blocks=25)
    assert tuples(cluster_pipeline(events, changed)) == expected


def test_order_and_layout_of_the_input_change_nothing(events):
    expected = tuples(cluster_pipeline(events, Settings(span_s=DAY, min_clusters=5)))
    shuffled = events.repartition(7, "doc").orderBy("query")
    assert tuples(cluster_pipeline(shuffled, Settings(span_s=DAY, min_clusters=5))) == expected


def test_fewer_refinements(events):
    clusters = cluster_pipeline(events, Settings(span_s=DAY, refs_per_query=6, min_clusters=3))
    assert max(sum(map(len, own)) for own in members(clusters).values()) == 6
    assert max(len(own) for own in members(clusters).values()) <= 6


def test_session_text_round_trip(spark, events, tmp_path):
    rows = run_level(events, "sessionConstruction", Settings(span_s=DAY))
    path = str(tmp_path / "sessions")
    write_level(rows, "sessionConstruction", path, "text")
    again = read_sessions(spark, path)
    assert tuples(again) == tuples(rows)
    assert distinct_session_refs(again).count() == distinct_session_refs(rows).count()


def test_cluster_text_round_trip(spark, make_log, tmp_path):
    rows = run_level(make_log(WORKED))
    path = str(tmp_path / "clusters")
    write_level(rows, "", path, "text")
    assert tuples(read_clusters(spark, path)) == tuples(rows)


def test_layouts(spark):
    df = spark.createDataFrame(
        [("1_2", "q", "r", "c", 3)],
        "session_id string, query string, refinement string, co_refinement string, count int",
    )
    assert lines(df, "co_occ") == ["q\tr\tc\t3"]
    assert lines(df, "general") == ["1_2\tq\tr\t3"]


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert storage.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")


def test_sizes_of_a_session_of_twenty_refinements(make_log):
    """Derived by counting: k refinements follow the k-th query from the end."""
    for users in (1, 2):
        log = make_log([(u, i * 1000, f"t{i:02}", "d" if i == 20 else "") for u in range(users) for i in range(21)])
        marked = materialise(sessions_of(log, Settings()), "marked")
        top = materialise(top_of(marked, Settings()), "top")
        assert marked.count() == 210 * users and top.count() == 210
        assert {r["count"] for r in top.collect()} == {users}
        co_occ = co_occ_of(marked, top)
        assert co_occ.count() == 1330 and docs_of(marked, top, Settings()).count() == 20
        clusters = cluster_pipeline(log, Settings())
        assert clusters.count() == 209 and clusters.select("query").distinct().count() == 19
        assert {r["ref_count"] for r in clusters.collect()} == {users}
        few = cluster_pipeline(log, Settings(min_clusters=3))
        assert few.groupBy("query").agg({"cluster_id": "max"}).filter("`max(cluster_id)` > 2").count() == 0
        assert few.count() == 209
