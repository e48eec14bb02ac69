from __future__ import annotations

import pytest
from conftest import tuples

from trailmine import schemas
from trailmine.operators.cooccurrence import (
    attach_ref_counts,
    co_occurrences,
    common_queries,
    filter_by_top_refs,
    symmetric_co_occ,
)
from trailmine.operators.counts import (
    count_co_occurrences,
    count_docs,
    count_refinements,
    distinct_session_refs,
    field_counts,
    in_frequent_buckets,
    top_docs,
    top_refinements,
)

ROWS = [
    ("1_0", 1, "q", "a", "", 1),
    ("1_0", 1, "q", "a", "d1", 1),
    ("1_0", 1, "q", "b", "", 1),
    ("1_0", 1, "q", "c", "d2", 1),
    ("2_0", 2, "q", "b", "d1", 1),
    ("2_0", 2, "q", "a", "d1", 1),
    ("2_1", 2, "p", "a", "", 1),
]


def frame(spark):
    return spark.createDataFrame(ROWS, schemas.SESSIONS)


def test_distinct_refinements_and_their_counts(spark):
    refs = distinct_session_refs(frame(spark))
    assert refs.count() == 6
    assert tuples(count_refinements(refs)) == [
        ("p", "a", 1),
        ("q", "a", 2),
        ("q", "b", 2),
        ("q", "c", 1),
    ]


def test_top_refinements_break_ties_by_name(spark):
    counts = count_refinements(distinct_session_refs(frame(spark)))
    assert tuples(top_refinements(counts, 1)) == [("p", "a", 1), ("q", "a", 2)]
    assert tuples(top_refinements(counts, 2), "query", "refinement") == [
        ("p", "a"),
        ("q", "a"),
        ("q", "b"),
    ]


def test_filter_by_top_refs(spark):
    top = spark.createDataFrame([("q", "a", 2), ("q", "c", 1)], schemas.REF_COUNTS)
    kept = filter_by_top_refs(frame(spark), top)
    assert sorted(r.refinement for r in kept.collect()) == ["a", "a", "a", "c"]
    clicks = filter_by_top_refs(frame(spark), top, clicks_only=True)
    assert tuples(clicks, "refinement", "doc") == [("a", "d1"), ("a", "d1"), ("c", "d2")]


def test_pairs_of_a_session(spark):
    pairs = co_occurrences(distinct_session_refs(frame(spark)))
    columns = ("query", "refinement", "co_refinement", "count")
    assert tuples(pairs, *columns) == [
        ("q", "a", "b", 1),
        ("q", "a", "b", 1),
        ("q", "a", "c", 1),
        ("q", "b", "c", 1),
    ]
    counted = count_co_occurrences(pairs)
    assert tuples(counted) == [("q", "a", "b", 2), ("q", "a", "c", 1), ("q", "b", "c", 1)]
    assert tuples(symmetric_co_occ(counted)) == [
        ("q", "a", "b", 2),
        ("q", "a", "c", 1),
        ("q", "b", "a", 2),
        ("q", "b", "c", 1),
        ("q", "c", "a", 1),
        ("q", "c", "b", 1),
    ]


def test_doc_counts_use_all_rows(spark):
    docs = count_docs(frame(spark).filter("doc != ''"))
    assert tuples(docs) == [("q", "a", "d1", 2), ("q", "b", "d1", 1), ("q", "c", "d2", 1)]


def test_top_docs(spark):
    docs = spark.createDataFrame(
        [("q", "a", "d1", 5), ("q", "a", "d2", 5), ("q", "a", "d3", 7), ("q", "b", "d1", 1)],
        schemas.DOC_COUNTS,
    )
    assert tuples(top_docs(docs, 2), "refinement", "doc") == [("a", "d1"), ("a", "d3"), ("b", "d1")]
    assert top_docs(docs, None).count() == 4


def test_common_queries(spark):
    left = spark.createDataFrame([("q", 1), ("p", 2)], "query string, x int")
    right = spark.createDataFrame([("q", 3), ("q", 4), ("r", 5)], "query string, y int")
    a, b = common_queries(left, right)
    assert (tuples(a), tuples(b)) == ([("q", 1)], [("q", 3), ("q", 4)])


def test_attach_ref_counts(spark):
    clusters = spark.createDataFrame([("q", 0, "a"), ("q", 1, "x")], schemas.CLUSTER_IDS)
    top = spark.createDataFrame([("q", "a", 9)], schemas.REF_COUNTS)
    assert tuples(attach_ref_counts(clusters, top)) == [("q", 0, "a", 9)]


@pytest.mark.parametrize("buckets", [1, 64, 1 << 16])
def test_field_counts_by_buckets_are_the_same(spark, buckets):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN concat('v', id % 7) WHEN id % 50 <> 1 THEN concat('u', id) END AS key")
    assert tuples(field_counts(rows, "key", 20, buckets)) == tuples(field_counts(rows, "key", 20))
    assert field_counts(rows.filter("false"), "key", 20, buckets).count() == 0


def test_rare_values_are_left_out_before_they_are_counted(spark):
    keys = spark.range(50_000).selectExpr("if(id % 10 = 0, 'often', concat('u', id)) AS key")
    left = in_frequent_buckets(keys, 1000, 1 << 12).groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in left}["often"] == 5000 and len(left) < 100
    with pytest.raises(ValueError):
        field_counts(keys, "key", buckets=0)
