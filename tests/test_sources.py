from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from trailmine.operators.counts import field_counts
from trailmine.sources import (
    parse_log_lines,
    read_clusters,
    read_log_fields,
    read_log_files,
    read_query_log,
    read_sessions,
    rejected_rows,
)

LINES = [
    "a\ta\ta\ta\ta",
    "7\tterm1\t2006-05-02 17:24:38\t\t",
    "7\tterm2\t2006-05-02 17:25:54\t\t",
    "7\tterm2\t2006-05-02 17:25:54\t\t",
    "7\t-\t2006-05-02 17:25:54\t\t",
    "7\tterm3\t2006-05-02 17:26:41",
    '7\tsay "hi\t2006-05-02 17:26:41\t\thttp://no.rank/',
    "7\tterm5\t2006-05-02 17:27:20\t1\thttp://site/\t",
    "7\tterm6\t2006-05-02 17:27:20\t1\thttp://site/\tmore",
    "71845\tterm1\t2006-05-02 17:24:38\t\t",
    "71845\tterm1\tno time",
    "7\tterm7\t2006-02-31 10:00:00\t\t",
    "7\tterm8",
    "7",
    "",
    "x\t-\tanything",
]


@pytest.fixture
def log_path(tmp_path) -> str:
    path = tmp_path / "log.tsv"
    path.write_text("\n".join(LINES))
    return str(path)


def test_log_rows(spark, log_path):
    rows = tuples(read_query_log(spark, log_path), "user_id", "query", "ts_ms", "doc")
    at = 1146590678000
    assert rows == [
        (7, 'say "hi', at + 123_000, "http://no.rank/"),
        (7, "term1", at, ""),
        (7, "term2", at + 76_000, ""),
        (7, "term2", at + 76_000, ""),
        (7, "term3", at + 123_000, ""),
        (7, "term5", at + 162_000, "http://site/"),
        # Six fields are not a clicked document.
        (7, "term6", at + 162_000, ""),
    ]


def test_sequence_follows_the_file(spark, log_path):
    rows = read_query_log(spark, log_path).orderBy("seq").collect()
    assert [r.query for r in rows][:2] == ["term1", "term2"]
    assert len({r.seq for r in rows}) == len(rows)


def test_times_are_read_in_the_session_zone(spark, log_path, with_conf):
    with_conf({"spark.sql.session.timeZone": "Europe/Berlin"})
    rows = read_query_log(spark, log_path).filter("query = 'term1'").collect()
    assert [r.ts_ms for r in rows] == [1146583478000]


def test_rejected_lines(spark, log_path):
    rejected = sorted(r.value for r in rejected_rows(spark, log_path).collect())
    assert rejected == sorted(
        [LINES[0], "7\tterm7\t2006-02-31 10:00:00\t\t", "7\tterm8", "7", ""]
    )


def test_other_bots(spark, log_path):
    assert read_query_log(spark, log_path, bot_users=[7]).count() == 1
    assert read_query_log(spark, log_path, bot_users=[]).count() == 8


@pytest.mark.parametrize("bots", [[7], [71845], [], [7, 71845]])
def test_a_table_of_bots_equals_a_list(spark, log_path, bots):
    """Repeated, unknown and null users in the table change nothing; one pass gives rows and rejected lines."""
    table = spark.createDataFrame([(b,) for b in [*bots, *bots, 123456, None]], "user_id long")
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    assert tuples(rejected_rows(spark, log_path, table)) == tuples(rejected_rows(spark, log_path, bots))
    columns = ("user_id", "query", "ts_ms", "doc")
    assert tuples(parse_log_lines(lines, table), *columns) == tuples(parse_log_lines(lines, bots), *columns)
    for given in (table, bots):
        files = read_log_files(spark, log_path, given)
        assert tuples(files.rows) == tuples(read_query_log(spark, log_path, bots))
        assert tuples(files.rejected) == tuples(rejected_rows(spark, log_path, bots))


def test_a_large_table_of_bots(spark, log_path):
    bots = spark.range(1_000_000).select((F.col("id") + 8).alias("user_id"))
    assert read_query_log(spark, log_path, bots).count() == 7


def test_rows_and_rejected_lines_are_read_from_one_pass(spark, log_path):
    """Neither frame reads the text again, and each only its own columns."""
    files = read_log_files(spark, log_path)
    for frame, content in ((files.rows, "row:struct<user_id"), (files.rejected, "bad:struct<value")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and content in plan.replace(" ", "")


def test_own_sequence(spark):
    lines = spark.createDataFrame([("1\tq\t2006-01-01 00:00:00", 42)], "value string, n int")
    assert parse_log_lines(lines, seq="n").first().seq == 42


def test_field_counts_of_lines_keep_bots_and_skip_missing_fields(spark, log_path):
    fields = read_log_fields(spark, log_path)
    users = tuples(field_counts(fields, "user_id", min_count=1), "key", "count", "line")
    assert users == [("7", 9, "     9\t7"), ("71845", 2, "     2\t71845")]
    urls = tuples(field_counts(fields, "url", min_count=1), "key", "count")
    assert urls == [("http://site/", 2)]


def test_wide_counts_are_not_cut(spark):
    many = spark.range(1_234_567).selectExpr("'k' AS key")
    assert field_counts(many, "key").first().line == "1234567\tk"


def test_sessions_text(spark, tmp_path):
    (tmp_path / "s.txt").write_text("1_5\tq\tr\td\t9\n1_5\tq\tr2\t\t1\n1_6\tq\tr3\n")
    rows = tuples(read_sessions(spark, str(tmp_path / "s.txt")))
    assert rows == [
        ("1_5", 1, "q", "r", "d", 1),
        ("1_5", 1, "q", "r2", "", 1),
        ("1_6", 1, "q", "r3", "", 1),
    ]


def test_cluster_text_reads_only_txt_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("q\t0\tr ü\t12\n", encoding="utf-8")
    (tmp_path / "b.log").write_text("no cluster line\n")
    assert tuples(read_clusters(spark, str(tmp_path))) == [("q", 0, "r ü", 12)]
