"""Vector codes against brute force, and on odd input."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import SF_DIR

from trailmine.llm import queries, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int"


def _brute(rows: list[list[int]], parts: int, entries: int, rounds: int):
    """Codebooks, and index and distance of each part of each row, in plain integers."""
    size = len(rows[0]) // parts
    cut = [[tuple(r[p * size : (p + 1) * size]) for p in range(parts)] for r in rows]
    books = [[r[p] for r in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(r[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for r in cut]

    for _ in range(rounds):
        given_out = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [r[p] for r, g in zip(cut, given_out) if g[p][1] == k]
                if own:
                    books[p][k] = tuple(sum(x) // len(own) for x in zip(*own))
    return books, assign()


def test_codes_equal_brute_force(spark):
    table = pd.read_parquet(f"{SF_DIR}/embeddings.parquet").sort_values("vec_id")
    rows = [[int(np.floor(np.float64(x) * 1024)) for x in v] for v in table.embedding]
    books, found = _brute(rows, 4, 256, 4)
    got = queries.op11_vector_codes(spark, SF_DIR).toPandas().set_index("vec_id")
    numbers = ",".join(str(x) for b in books for e in b for x in e)
    assert set(got.codebooks_sha256) == {hashlib.sha256(numbers.encode()).hexdigest()}
    errors = {i: sum(d for d, _ in f) for i, f in zip(table.vec_id, found)}
    assert got.error.to_dict() == errors
    assert got.code.to_dict() == {i: "".join(f"{k:02x}" for _, k in f) for i, f in zip(table.vec_id, found)}
    of = table.set_index("vec_id").label
    assert all(e == sum(errors[j] for j in of.index if of[j] == of[i]) for i, e in got.label_error.head(40).items())


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_nearest_entries_of_ties_and_large_numbers(data):
    width = data.draw(st.integers(1, 4))
    number = st.integers(-3, 3) if data.draw(st.booleans()) else st.integers(-(1 << 60), 1 << 60)
    row = st.lists(number, min_size=width, max_size=width)
    entries = np.array(data.draw(st.lists(row, min_size=1, max_size=60)), np.int64)
    rows = np.array(data.draw(st.lists(row, min_size=1, max_size=10)), np.int64)
    kind = vector_codes.exact_kind(entries, rows)
    got = vector_codes.Gnat(entries.astype(kind)).nearest(rows.astype(kind))
    for row, index, distance in zip(rows.tolist(), got.index.tolist(), got.distance.tolist()):
        want = min((sum((x - y) ** 2 for x, y in zip(row, e)), k) for k, e in enumerate(entries.tolist()))
        assert (int(distance), index) == want


def test_whole_subtrees_are_left_out():
    rng = np.random.default_rng(2)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    entries = (centres[rng.integers(0, 16, 256)] + rng.integers(-50, 50, (256, 8))).astype(float)
    rows = (centres[rng.integers(0, 16, 2000)] + rng.integers(-50, 50, (2000, 8))).astype(float)
    got = vector_codes.Gnat(entries).nearest(rows)
    assert np.array_equal(got.index, np.argmin(vector_codes.squared(rows, entries), axis=1))
    assert got.looked_at < 0.25 * rows.shape[0] * len(entries)


def _plain(rows, **options):
    coded = vector_codes.encode_vectors(rows, **options)
    return {r["vec_id"]: (r["code"], r["error"]) for r in coded.rows.collect()}, coded.codebooks.entries


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [nan, 0.0], 1), (3, [inf, 0.0], None), (4, [None, 1.0], 2), (5, [], None), (6, [0.5, -0.25, 1.0, 2.0, 3.0], None),
            (7, [0.5, -0.25, 1.0, 2.0, 3.0], 7), (None, [1.0], 7), (8, [1e300, -1e300], 7)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS + ", code string, error long, part int").repartition(3)
    got, entries = _plain(df)
    assert set(got) == {5, 6, 7, 8, None} and entries.shape == (4, 5, 2)
    assert got[6] == got[7] and all(len(code) == 8 for code, _ in got.values())
    assert entries[0, 1].tolist() == [512, -256] and got[5][1] == 0
    none, entries = _plain(spark.createDataFrame([], VECTORS))
    assert none == {} and entries.shape == (4, 0, 0)
    unfit, _ = _plain(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert unfit == {}


def test_repeated_ids_and_unused_entries(spark, tmp_path):
    rows = [(1, [0.0, 0.0], 1), (1, [0.0, 0.0], None), (1, [1.0, 5.0], None), (2, [-0.001, 5.0], 1)]
    spark.createDataFrame(rows, VECTORS).repartition(2).write.parquet(str(tmp_path / "embeddings.parquet"))
    coded = vector_codes.encode_vectors(spark.read.parquet(str(tmp_path / "embeddings.parquet")), parts=2, entries=3, rounds=2)
    books, found = _brute([[0, 0], [0, 0], [1024, 5120], [-2, 5120]], 2, 3, 2)
    assert [[tuple(e) for e in b] for b in coded.codebooks.entries.tolist()] == books
    assert sorted(r["error"] for r in coded.rows.collect()) == sorted(sum(d for d, _ in f) for f in found)
    wide = spark.createDataFrame([(i, [float(i)] * 4, i % 2 or None) for i in range(20)], VECTORS)
    wide.write.parquet(str(tmp_path / "few" / "embeddings.parquet"))
    got = queries.op11_vector_codes(spark, str(tmp_path / "few")).collect()
    assert len(got) == 20 and {r["label_error"] for r in got} == {0} and got[0]["code"] == f"{got[0]['vec_id']:02x}" * 4


@pytest.mark.parametrize("n", [300])
def test_more_entries_than_two_digits(spark, n):
    df = spark.createDataFrame([(i, [float(i)], None) for i in range(n)], VECTORS)
    got, _ = _plain(df, parts=1, entries=n, rounds=1)
    assert got[299] == ("12b", 0) and got[0] == ("000", 0)
