from __future__ import annotations

import random

import numpy as np
import pytest
import twin
from conftest import tuples

from trailmine import schemas
from trailmine.operators.walk import (
    absorption_factors,
    absorption_vectors,
    doc_steps,
    pair_products,
    ref_similarity,
    ref_steps,
    reference_rows,
    row_normalise,
    similarity_from_products,
    transition_table,
    vector_products,
    vectors_of_factors,
)


def random_query(seed, refs=9, docs=14):
    """Counts of one query; some refinements have no clicks, one has only clicks."""
    rng = random.Random(seed)
    names = [f"r{i}" for i in range(refs)]
    co = {
        (a, b): rng.randrange(1, 9)
        for i, a in enumerate(names)
        for b in names[i + 1 :]
        if rng.random() < 0.4
    }
    clicks = {
        (rng.choice(names[: refs - 2] + ["only clicked"]), f"d{rng.randrange(docs)}"): rng.randrange(1, 9)
        for _ in range(docs)
    }
    return co, clicks


def frames(spark, queries):
    co = [(q, a, b, n) for q, (pairs, _) in queries.items() for (a, b), n in pairs.items()]
    docs = [(q, r, d, n) for q, (_, clicks) in queries.items() for (r, d), n in clicks.items()]
    return spark.createDataFrame(co, schemas.CO_OCC), spark.createDataFrame(docs, schemas.DOC_COUNTS)


@pytest.fixture(scope="module")
def queries():
    return {f"q{seed}": random_query(seed) for seed in range(4)}


def test_row_normalise(spark):
    df = spark.createDataFrame(
        [("q", "a", 1), ("q", "a", 3), ("q", "b", 0)], "query string, r string, n int"
    )
    rows = tuples(row_normalise(df, ["query", "r"], "n"), "r", "n", "p")
    assert rows == [("a", 1, 0.25), ("a", 3, 0.75), ("b", 0, 0.0)]


def test_worked_transition(spark):
    co, docs = frames(spark, {"q": ({("a", "b"): 2}, {("a", "d"): 5, ("zz", "e"): 1})})
    steps = {(r.src, r.dst, r.kind): r.p for r in transition_table(co, docs).collect()}
    # Weights of a: 0.4 to b, 0.6 to d, 1/2 topic. b has no click: 0.4 to a, 1/2 topic.
    assert steps == pytest.approx(
        {
            ("a", "b", "ref"): 0.4 / 1.5,
            ("a", "d", "doc"): 0.6 / 1.5,
            ("a", "", "topic"): 0.5 / 1.5,
            ("b", "a", "ref"): 0.4 / 0.9,
            ("b", "", "topic"): 0.5 / 0.9,
        }
    )


def test_queries_need_pairs_and_clicks(spark):
    co, docs = frames(
        spark,
        {"both": ({("a", "b"): 1}, {("z", "d"): 1}), "pairs": ({("a", "b"): 1}, {}), "clicks": ({}, {("a", "d"): 1})},
    )
    rows = tuples(reference_rows(co, docs), "query", "refinement", "n_refs", "query_docs")
    assert rows == [("both", "a", 2, 0), ("both", "b", 2, 0)]


@pytest.mark.parametrize("entries", [10**6, 20])
def test_vectors_equal_the_squared_matrix(spark, queries, entries):
    vectors = vectors_of_factors(*absorption_factors(transition_table(*frames(spark, queries))), entries)
    got = {(r.query, r.refinement, r.doc): r.p for r in vectors.collect()}
    expected = {}
    for query, (co, clicks) in queries.items():
        expected |= {(query, *key): p for key, p in twin.absorption_by_paths(co, clicks, 0.6, 16).items()}
    assert got == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("mode", ["max_product", "cosine"])
def test_similarity_forms_agree(spark, queries, mode):
    co, docs = frames(spark, queries)
    single = ref_similarity(absorption_vectors(transition_table(co, docs)), mode)
    expected = {tuple(r)[:3]: r.similarity for r in single.collect()}
    for query, (pairs, clicks) in queries.items():
        entries = twin.absorption_by_paths(pairs, clicks, 0.6, 16)
        refs, names = sorted({r for pair in pairs for r in pair}), sorted({d for _, d in entries})
        v = np.array([[entries.get((r, d), 0.0) for d in names] for r in refs])
        for i, a in enumerate(refs):
            for j in range(i + 1, len(refs)):
                product = v[i] * v[j]
                value = product.max() if mode == "max_product" else product.sum()
                if value > 0:
                    value /= np.linalg.norm(v[i]) * np.linalg.norm(v[j])
                    assert expected[query, a, refs[j]] == pytest.approx(value)
                else:
                    assert (query, a, refs[j]) not in expected
    rows = reference_rows(co, docs)
    for limit in (10**6, 2):
        products = vector_products(ref_steps(co, rows), doc_steps(docs, rows), doc_rows_per_task=limit)
        fused = similarity_from_products(products, mode).collect()
        got = {(r.query, r.refinement, r.co_refinement): r.similarity for r in fused}
        assert got == pytest.approx(expected)
    parts = ref_similarity(absorption_vectors(transition_table(co, docs)), mode, rows_per_task=7).collect()
    assert {(r.query, r.refinement, r.co_refinement): r.similarity for r in parts} == pytest.approx(expected)


def test_vectors_keep_the_weakest_entries(spark):
    steps = [("q", "a", "b", "ref", 1e-200), ("q", "b", "d", "doc", 1e-200), ("other", "x", "y", "ref", 0.5)]
    transitions = spark.createDataFrame(steps, "query string, src string, dst string, kind string, p double")
    assert tuples(absorption_vectors(transitions)) == [("q", "a", "d", 0.0), ("q", "b", "d", 1e-200)]
    assert absorption_vectors(transitions.limit(0)).count() == ref_similarity(absorption_vectors(transitions.limit(0))).count() == 0


@pytest.mark.parametrize("n", [1, 3, 12])
def test_products_of_documents_of_any_size(n):
    """Documents of one entry up to all refinements, so both ways are taken for n = 12."""
    rng = np.random.default_rng(n)
    cells = [(r, d) for d in range(40) for r in rng.permutation(n)[: 1 + d % n]]
    ref, doc = np.array(cells)[rng.permutation(len(cells))].T
    p = rng.random(len(ref))
    p[0] = 1e-300
    largest, total = pair_products(ref, doc, p, n)
    entry = {(r, d): v for r, d, v in zip(ref, doc, p)}
    for i in range(n):
        for j in range(i, n):
            met = [entry[i, d] * entry[j, d] for d in range(40) if (i, d) in entry and (j, d) in entry]
            assert largest[i, j] == max(met, default=-1)
            assert total[i, j] == pytest.approx(sum(met))
