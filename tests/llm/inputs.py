"""Inputs of the tests; the fixtures are imported where they are used."""

from __future__ import annotations

import pandas as pd
import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"

#: Null, empty, blank, tied, repeated, very long and non-Latin texts; a null id.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "one two"), (7, "one two three four five six seven"),
    (8, "one two three four five six seven"), (9, "ONE two three four five six seven"), (None, "one two three four five six seven"),
    (10, "日本語 の 文章 です 。 これ は 長い"), (11, "word " * 30_000), (12, "x" * 200_000), (12, "x" * 200_000), (13, "!!! ... ???"),
]


@pytest.fixture(scope="session")
def documents() -> pd.DataFrame:
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def odd_docs(spark):
    """Odd texts beside columns of clashing names."""
    rows = [(i, t, "x", 1, 2.0) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, DOCS + ", hits string, n_words int, score double").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
