"""Streams give the rows of a batch."""

from __future__ import annotations

import random

import pytest
from conftest import tuples

from trailmine import schemas
from trailmine.operators.sessions import session_starts
from trailmine.streaming.starts import stream_session_starts

HOUR = 3_600_000


def _rows(spark, records):
    """``(user, ms, seq, query)`` as a log."""
    made = spark.createDataFrame(records, "user_id bigint, ts_ms bigint, seq bigint, query string")
    return made.selectExpr("user_id", "timestamp_millis(ts_ms) AS ts", "ts_ms", "seq", "query", "'' AS doc")


def _streamed(spark, folder, files, delay="1 hour", stops=(), seeds=None):
    """Starts of a stream that reads one file at a time, stopped and taken up again at ``stops``."""
    for k, records in enumerate(files):
        _rows(spark, records).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if k in stops or k == len(files) - 1:
            log = spark.readStream.schema(schemas.LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
            query = stream_session_starts(log, 600, seeds, delay).writeStream.option("checkpointLocation", f"{folder}/place")
            query.trigger(availableNow=True).start(f"{folder}/out", "parquet", "append").awaitTermination()
    return tuples(spark.read.schema(schemas.STARTS).parquet(f"{folder}/out"))


def _batch(spark, records, seeds=None):
    return tuples(session_starts(_rows(spark, records), 600, seeds))


def _random_log(seed, n=400):
    draw = random.Random(seed)
    times = sorted(draw.choices(range(0, 10 * HOUR, 500), k=n))
    return [(draw.randrange(4), ms, seq, draw.choice(["a", "b", "c", ""])) for seq, ms in enumerate(times)]


@pytest.mark.parametrize("seeds", [None, ["a", "c"]])
def test_streamed_starts_equal_the_batch(spark, tmp_path, seeds):
    """Records come up to half an hour out of order, and the stream is restarted on the way."""
    log = _random_log(5)
    draw = random.Random(1)
    late = sorted(log, key=lambda r: r[1] + draw.randrange(HOUR // 2))
    files = [late[k : k + 100] for k in range(0, 400, 100)] + [[(9, 100 * HOUR, 1000, "z")]]
    got = _streamed(spark, tmp_path, files, stops=(1,), seeds=seeds)
    assert got == _batch(spark, log, seeds) and len(got) > 50


def test_late_records_are_left_out_and_the_last_ones_wait(spark, tmp_path):
    first = [(1, 10 * HOUR, 1, "a"), (1, 12 * HOUR, 2, "b")]
    second = [(1, 9 * HOUR, 3, "late"), (1, 11 * HOUR + 1, 4, "c"), (2, 20 * HOUR, 5, "d")]
    got = _streamed(spark, tmp_path, [first, second], stops=(0,))
    # "d" is the latest record, so the watermark has not passed it.
    assert got == [(1, "a", 10 * HOUR, 1), (1, "b", 12 * HOUR, 2), (1, "c", 11 * HOUR + 1, 4)]


def test_ties_null_queries_and_an_empty_stream(spark, tmp_path):
    log = [(1, 5000, 2, "b"), (1, 5000, 1, "a"), (1, 5000, 3, None), (1, 6000, 4, "c"), (1, 7000, 5, "a"), (1, 606_000, 6, "x"), (1, 606_001, 7, "a"), (2, 0, 8, "")]
    got = _streamed(spark, tmp_path / "some", [log, [(9, 100 * HOUR, 9, "z")]])
    assert got == _batch(spark, log)
    assert _streamed(spark, tmp_path / "none", [[]]) == []
