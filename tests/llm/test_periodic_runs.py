"""Periodic runs against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import zlib

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import DOCS, ODD_TEXTS, SF_DIR, documents, no_docs, odd_docs  # noqa: F401

from trailmine.llm import periodic_runs, queries, text


def _plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs, by walking along every period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 4 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        begin = None
        for i, equal in enumerate(same):
            if equal and begin is None:
                begin = i
            elif not equal and begin is not None:
                if i - begin + q >= max(6, 4 * q):
                    found.setdefault((begin, i - begin + q), q)
                begin = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _plain_collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def _planted(doc_id: int, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_equal_brute_force(spark, documents):
    got = queries.op13_periodic_runs(spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == len(documents) and (got.n_runs > 0).any()
    for i, body in zip(documents.doc_id, documents.text):
        words = _planted(i, brute.BLANK_WORD.findall(body or ""))
        runs, row = _plain_runs(words), got.loc[i]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(_plain_collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, n, q = max(runs, key=lambda r: (r[1], -r[0], -r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert got.loc[[i], ["start", "length", "period", "exponent_milli"]].isna().all(axis=None)


_TEXT = st.lists(st.integers(0, 3), max_size=60)
_TAIL = st.tuples(_TEXT, st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(0, 12)).map(lambda x: x[0] + x[1] * x[2])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(_TEXT, _TAIL), min_size=1, max_size=4), st.sampled_from([1, 7, 1 << 20]))
def test_runs_of_small_alphabets(texts, portion):
    before, periodic_runs.PORTION = periodic_runs.PORTION, portion
    try:
        first = np.cumsum([0] + [len(t) for t in texts])
        numbers = np.array([4 * k + x for k, t in enumerate(texts) for x in t], np.int64)
        got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(numbers, first))))
        assert got == [(s + int(first[k]), n, q) for k, t in enumerate(texts) for s, n, q in _plain_runs(t)]
    finally:
        periodic_runs.PORTION = before


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("aabc"), min_size=2, max_size=80), st.data())
def test_extensions_of_the_grammar(letters, data):
    sequence = np.array([100, *map(ord, letters), 101])
    grammar = periodic_runs.Grammar(sequence)
    a = data.draw(st.integers(1, len(letters) - 1))
    b = data.draw(st.integers(a + 1, len(letters)))
    plain = lambda step, n=0: next(n for n in range(len(sequence)) if sequence[a + step * n] != sequence[b + step * n])
    for step in (1, -1):
        assert grammar.extend(np.array([a]), np.array([b]), step).tolist() == [plain(step)]


def test_the_grammar_is_small_and_climbed():
    rng = np.random.default_rng(1)
    sequence = np.concatenate([[-1], np.tile(rng.integers(0, 5000, 1000), 50), [-2]])
    grammar = periodic_runs.Grammar(sequence)
    assert len(grammar.symbol) < 6 * len(sequence)
    steps = []
    whole = np.minimum
    try:
        np.minimum = lambda x, y, **k: steps.append(1) or whole(x, y, **k)
        assert grammar.extend(np.array([1]), np.array([1001]), 1).tolist() == [49_000]
    finally:
        np.minimum = whole
    assert len(steps) < 200


def test_words_that_share_a_hash():
    words = text.words_of(pa.array(["x y x y x y x y"]), lower=False)
    clash = text.Words(words.data, words.starts, words.ends, np.zeros_like(words.hashes), words.first)
    numbers = periodic_runs.word_numbers(clash, clash.owner)
    assert len(set(numbers.tolist())) == 2 and periodic_runs.runs_of(numbers, words.first)[2].tolist() == [2]


def test_runs_of_odd_texts(spark, odd_docs, no_docs):
    got = periodic_runs.find_runs(odd_docs).collect()
    assert len(got) == len(ODD_TEXTS)
    for row in got:
        words = brute.BLANK_WORD.findall(row["text"] or "")
        assert row["n_words"] == len(words)
        if row["doc_id"] == 11:
            assert [tuple(r) for r in row["runs"]] == [(0, 30_000, 1)] and row["collapsed"] == "word"
        else:
            assert row["runs"] == [] and row["collapsed"] == " ".join(words)
    assert periodic_runs.find_runs(no_docs).count() == 0
    cases = spark.createDataFrame([(1, "A a A a A a A a"), (1, "a a\na\ta a a"), (2, "x" + " a b" * 3 + " a a b a b a b a b")], DOCS + "")
    got = periodic_runs.find_runs(cases.selectExpr("*", "1 as runs", "2 as collapsed")).collect()
    assert sorted((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == [
        (1, [(0, 6, 1)], "a"), (1, [(0, 8, 2)], "A a"), (2, [(8, 8, 2)], "x a b a b a b a a b")]


def test_tails_of_odd_rows(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r["text"] for r in queries.with_periodic_tails(odd_docs).collect() if r["doc_id"] is not None}
    for i, body in ODD_TEXTS:
        if i is not None and body is not None and zlib.crc32(str(i).encode()) % 10 == 0:
            assert got[i].split() == _planted(i, body.split())
        elif i is not None:
            assert got[i] == body
    assert queries.with_periodic_tails(no_docs).count() == 0
