"""The jobs as started from a shell, and what they leave behind."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier, Event

import pytest
from conftest import tuples

from trailmine.__main__ import main
from trailmine.operators.counts import count_refinements, first_session_refs
from trailmine.operators.sessions import mark_sessions, session_starts
from trailmine.operators.suggest import suggest
from trailmine.sinks import write_level, write_suggestions
from trailmine.sources import read_query_log, read_suggestions
from trailmine.storage import materialise, materialise_together, scratch_root, scratch_scope

LINES = [
    "9\tterm1\t2006-03-01 17:24:38",
    "9\tterm2\t2006-03-01 17:25:54",
    "9\tterm3\t2006-03-01 17:26:41",
    "9\tterm4\t2006-03-01 17:27:20\t1\thttp://d",
    "9\t-\t2006-03-01 17:27:30",
    "broken",
]


@pytest.fixture
def log_path(tmp_path) -> str:
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.tsv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "in")


def _lines(path) -> list[str]:
    return sorted(line for p in Path(path).glob("part-*") for line in p.read_text().splitlines())


@pytest.mark.parametrize("level, n, first", [
    ("logMap", 4, "9\t"), ("countRef", 6, "q: term1\tr: term2\t1"), ("", 5, "term1\t0\tterm2\t1"), ("anything", 5, "term1\t0\tterm2\t1")])
def test_cluster_job(spark, log_path, tmp_path, level, n, first):
    before = set(Path(scratch_root(spark)).glob("scope-*"))
    main(["cluster", log_path, str(tmp_path / "out"), level])
    lines = _lines(tmp_path / "out")
    assert len(lines) == n and lines[0].startswith(first)
    assert set(Path(scratch_root(spark)).glob("scope-*")) == before


def test_cluster_job_with_options(spark, log_path, tmp_path):
    (tmp_path / "seeds.txt").write_text("term1\nterm3\n")
    (tmp_path / "bots.txt").write_text(" 9 \nnobody\n")
    main(["cluster", log_path, str(tmp_path / "a"), "countRef", "--seeds", str(tmp_path / "seeds.txt")])
    assert [x.split("\t")[0] for x in _lines(tmp_path / "a")] == ["q: term1"] * 3 + ["q: term3"]
    main(["cluster", log_path, str(tmp_path / "b"), "countRef", "--span", "80"])
    assert len(_lines(tmp_path / "b")) == 3
    main(["cluster", log_path, str(tmp_path / "c"), "topCountRef", "--refs-per-query", "1"])
    assert len(_lines(tmp_path / "c")) == 3
    main(["cluster", log_path, str(tmp_path / "d"), "logMap", "--bots", str(tmp_path / "bots.txt")])
    assert _lines(tmp_path / "d") == []


def test_field_count_job(spark, log_path, tmp_path):
    main(["field-counts", log_path, str(tmp_path / "a"), "0", "--min-count", "1"])
    main(["field-counts", log_path, str(tmp_path / "b"), "query", "--min-count", "0"])
    assert _lines(tmp_path / "a") == ["     4\t9"]
    assert _lines(tmp_path / "b") == [f"     1\tterm{k}" for k in (1, 2, 3, 4)]


def test_the_cut_of_files_changes_nothing(spark, with_conf, tmp_path):
    """Equal seconds in several files, read in large and in small splits."""
    folder = tmp_path / "logs"
    folder.mkdir()
    for name, size in (("b", 3000), ("a", 900), ("c", 40)):
        rows = (f"{k % 7}\t{name}{k % 11}\t2006-03-01 10:{k % 3:02}:00" for k in range(size))
        (folder / f"{name}.tsv").write_text("".join(f"{r}\n" for r in rows))
    found = []
    for size in ("128m", "9k"):
        with_conf({"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1k"})
        log = read_query_log(spark, str(folder))
        counts = count_refinements(first_session_refs(mark_sessions(log)))
        found.append((tuples(log), tuples(session_starts(log)), tuples(counts)))
    assert found[0] == found[1]
    by_seq = [row[4][0] for row in sorted(found[0][0], key=lambda row: row[3])]
    assert by_seq == ["a"] * 900 + ["b"] * 3000 + ["c"] * 40


def test_scope_removes_its_tables(spark):
    with scratch_scope(spark):
        table = materialise(spark.range(3).toDF("x"), "kept")
        path = Path(table.inputFiles()[0].removeprefix("file://")).parent
        assert path.exists() and table.count() == 3
    assert not path.exists()


def test_unknown_levels_and_lacking_columns_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([("q", 0, "r")], "query string, cluster_id int, refinement string")
    with pytest.raises(ValueError, match="no level"):
        write_level(frame, "custer", str(tmp_path / "x"), "text")
    with pytest.raises(ValueError, match="refinement"):
        write_level(frame.drop("refinement"), "cluster", str(tmp_path / "x"), "text")


def test_a_table_grows_and_requests_are_trimmed(spark, tmp_path):
    rows = [("b", 0, "x", 2), ("a", 0, "y", 1)]
    frame = spark.createDataFrame(rows, "query string, cluster_id int, refinement string, ref_count bigint")
    write_suggestions(frame.filter("query = 'b'"), str(tmp_path / "t"))
    write_suggestions(frame.filter("query = 'a'"), str(tmp_path / "t"), mode="append")
    table = read_suggestions(spark, str(tmp_path / "t"))
    asked = spark.createDataFrame([("\t a\x01\r\n",), ("b ",)], "query string")
    assert tuples(suggest(table, asked), "query", "refinement") == [("a", "y"), ("b", "x")]


def test_scopes_of_threads_are_their_own(spark):
    """One job that ends leaves the tables of another; frames written together are in the caller's scope."""
    both = Barrier(2, timeout=120)

    def job(n):
        with scratch_scope(spark):
            frames = materialise_together({"a": spark.range(n), "b": spark.range(n)})
            both.wait()
            if n == 1:  # ends first
                return frames[0].count()
            ended.wait(120)
            return frames[0].union(frames[1]).count(), [f.inputFiles()[0].split("/")[-3] for f in frames]

    ended = Event()
    with ThreadPoolExecutor(2) as pool:
        long, short = pool.submit(job, 5), pool.submit(job, 1)
        assert short.result() == 1
        ended.set()
        count, folders = long.result()
    assert count == 10 and folders[0] == folders[1] and folders[0].startswith("scope-")
