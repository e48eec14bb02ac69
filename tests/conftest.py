from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trailmine import build_spark, schemas  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_spark(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def with_conf(spark) -> Iterable[Callable[..., None]]:
    """Set session options for one test."""
    before: dict[str, str | None] = {}

    def change(options: dict[str, str]) -> None:
        for name, value in options.items():
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def make_log(spark) -> Callable[..., DataFrame]:
    """Log frame from ``(user, ms, query, doc)`` records; their place is the order."""

    def make(records) -> DataFrame:
        rows = [(u, None, ms, i, q, d) for i, (u, ms, q, d) in enumerate(records)]
        return spark.createDataFrame(rows, schemas.LOG)

    return make


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in sorted order."""
    return sorted(tuple(row) for row in df.select(*(columns or df.columns)).collect())
