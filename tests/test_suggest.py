from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from trailmine import schemas
from trailmine.operators.suggest import headline_suggestions, nest_suggestions, suggest
from trailmine.plans.lookup import look_up
from trailmine.sinks import replace_suggestions, write_suggestions
from trailmine.sources import read_suggestions
from trailmine.sources.tables import bucket_of

CLUSTERS = [
    ("q", 0, "a", 5),
    ("q", 0, "b", 1),
    ("q", 1, "c", 9),
    ("q", 2, "d", 5),
    ("two words", 0, "e", 1),
    ("unasked", 0, "f", 1),
]


def frames(spark):
    clusters = spark.createDataFrame(CLUSTERS, schemas.CLUSTERS)
    requests = spark.createDataFrame([(" q ",), ("q",), ("two words",), ("no",)], "query string")
    return clusters, requests


def scans_of(df):
    """The file scans of a plan that has not run."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_rows_are_ranked_and_cut(spark):
    rows = tuples(suggest(*frames(spark), limit=3), "query", "rank", "refinement")
    assert rows == [("q", 1, "c"), ("q", 2, "a"), ("q", 3, "d"), ("two words", 1, "e")]


def test_nesting_and_headlines(spark):
    nested = nest_suggestions(suggest(*frames(spark)))
    assert {r.query: r.suggestions for r in nested.collect()} == {
        "q": [["c"], ["a", "b"], ["d"]],
        "two words": [["e"]],
    }
    lines = headline_suggestions(nested).filter("query = 'q'").orderBy("position").collect()
    assert [(r.headline, r.others) for r in lines] == [("c", []), ("a", ["b"]), ("d", [])]


def test_suggestion_table_is_replaced(spark, tmp_path):
    clusters, _ = frames(spark)
    path = str(tmp_path / "table")
    write_suggestions(clusters, path)
    write_suggestions(clusters.filter("query = 'q'"), path)
    assert tuples(read_suggestions(spark, path)) == sorted(CLUSTERS[:4])


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_queries_of_a_table_are_replaced(spark, tmp_path, buckets):
    clusters, _ = frames(spark)
    path = str(tmp_path / "table")
    for _ in range(2):
        replace_suggestions(clusters, path, buckets)
        assert tuples(read_suggestions(spark, path)) == sorted(CLUSTERS)
    new = spark.createDataFrame([("q", 0, "z", 1), ("more", 0, "y", 2)], schemas.CLUSTERS)
    for _ in range(2):
        replace_suggestions(new, path, 7)
        assert tuples(read_suggestions(spark, path)) == sorted(CLUSTERS[4:] + [("q", 0, "z", 1), ("more", 0, "y", 2)])
    replace_suggestions(new.limit(0), path)
    assert read_suggestions(spark, path).count() == 4


def test_only_buckets_of_new_queries_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(f"query {i}", 0, "r", i) for i in range(200)], schemas.CLUSTERS)
    path = str(tmp_path / "table")
    replace_suggestions(rows, path, 20)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    replace_suggestions(rows.filter("query = 'query 7'"), path)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    assert len({f.parent for f in set(before) ^ set(after)}) == 1
    assert read_suggestions(spark, path).count() == 200


@pytest.mark.parametrize("write", [write_suggestions, replace_suggestions])
def test_lookup_equals_suggestions_of_the_whole_table(spark, tmp_path, write):
    clusters, requests = frames(spark)
    path = str(tmp_path / "table")
    write(clusters, path)
    assert tuples(look_up(path, requests, 3)) == tuples(suggest(clusters, requests, 3))
    assert look_up(path, requests.limit(0)).count() == look_up(path, requests.filter("query = 'no'")).count() == 0


def test_lookup_reads_only_folders_of_the_requests(spark, tmp_path):
    rows = spark.createDataFrame([(f"query {i}", 0, "r", i) for i in range(200)], schemas.CLUSTERS)
    path = str(tmp_path / "table")
    replace_suggestions(rows, path, 20)
    asked = spark.createDataFrame([(" query 7",), ("query 7 ",), ("query 8",)], "query string")
    found = look_up(path, asked)
    assert tuples(found, "query", "ref_count") == [("query 7", 7), ("query 8", 8)]
    scan = next(s for s in scans_of(found) if "bucket" in s.relation().partitionSchema().toString())
    read = {str(scan.inputRDD().partitions()[i].files()[j].filePath()).split("bucket=")[1].split("/")[0]
            for i in range(len(scan.inputRDD().partitions())) for j in range(len(scan.inputRDD().partitions()[i].files()))}
    buckets = {r[0] for r in rows.filter("query in ('query 7', 'query 8')").select(bucket_of(F.col("query"), 20)).collect()}
    assert read == buckets and len(read) < 20


def test_a_table_without_buckets_is_not_replaced(spark, tmp_path):
    clusters, _ = frames(spark)
    write_suggestions(clusters, str(tmp_path / "table"))
    with pytest.raises(ValueError):
        replace_suggestions(clusters, str(tmp_path / "table"))
