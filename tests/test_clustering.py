from __future__ import annotations

import random
import time

import numpy as np
import pandas as pd
import pytest
import twin
from conftest import tuples

from trailmine import schemas
from trailmine.operators.clustering import cluster_refinements, complete_link, significant
from trailmine.operators.walk import entry_products, reach_matrix


def random_similarity(seed, n, levels):
    rng = random.Random(seed)
    s = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            s[i, j] = s[j, i] = rng.choice([0, *[k / levels for k in range(1, levels)]])
    return s


@pytest.mark.parametrize("seed", range(12))
def test_merging_equals_the_search(seed):
    # Few levels give many ties.
    similarity = random_similarity(seed, 14, 3 + 30 * (seed % 2))
    for least in (1, 3, 8, 14, 20):
        clusters = complete_link(similarity, least)
        assert twin.is_complete_link(similarity, clusters, least)
        assert [max(c) for c in clusters] == sorted(max(c) for c in clusters)


def _search_all(similarity, min_clusters):
    """Merges by a search over the whole matrix."""
    n = len(similarity)
    link = {(i, j): max(similarity[i][j], similarity[j][i]) for i in range(n) for j in range(i)}
    clusters = {i: [i] for i in range(n)}
    while len(clusters) > min_clusters:
        value, high, low = max(((v, *pair) for pair, v in link.items()), default=(0, 0, 0))
        if value <= 0:
            break
        pair = lambda x, y: (max(x, y), min(x, y))
        for other in clusters:
            if other not in (high, low):
                link[pair(other, high)] = min(link[pair(other, high)], link[pair(other, low)])
        clusters[high] = clusters[high] + clusters.pop(low)
        link = {p: v for p, v in link.items() if low not in p}
    return [clusters[i] for i in sorted(clusters)]


@pytest.mark.parametrize("seed", range(30))
def test_kept_maxima_equal_a_search_of_the_matrix(seed):
    rng = np.random.default_rng(seed)
    n, levels = int(rng.integers(2, 45)), int(rng.choice([2, 4, 1000]))
    similarity = np.triu(rng.integers(0, levels, (n, n)) / levels, 1)
    for least in (1, n // 3, n):
        assert complete_link(similarity + similarity.T, least) == _search_all(similarity, least)


def test_two_thousand_refinements_are_merged_in_time():
    rng = np.random.default_rng(0)
    begin = time.perf_counter()
    assert len(complete_link(rng.random((2000, 2000)), 20)) == 20
    assert time.perf_counter() - begin < 20


def test_nothing_similar_stays_apart():
    assert complete_link(np.zeros((5, 5)), 1) == [[i] for i in range(5)]


@pytest.mark.parametrize("least_count", [1, 1e-5, 1e-6, 1e-12])
def test_weak_links_still_merge(least_count):
    # A chain of 30 refinements whose counts fall from 1 to the least.
    n = 30
    counts = np.geomspace(1, least_count, n)
    steps = pd.DataFrame([{"src": f"r{i:02}", "dst": f"r{j:02}", "p": 0.5 * counts[max(i, j)]}
                          for i in range(n) for j in (i - 1, i + 1) if 0 <= j < n])
    names, reach = reach_matrix(steps, 5)
    clicks = pd.DataFrame({"src": names, "dst": [f"d{i}" for i in range(n)], "p": 0.3 * counts})
    largest, total = entry_products(names, reach, clicks)
    norm = np.sqrt(np.diag(total))
    link = significant(largest / np.outer(norm, norm))
    assert (link > 0).sum() == (largest > 0).sum()
    assert len(complete_link(link, 5)) == 5


def test_significant_digits():
    values = np.array([0.0, 1e-300, 3e-20, 0.1 + 0.2, 1.0, 12345.678901234567])
    got = significant(values)
    assert got[0] == 0 and (got[1:] > 0).all() and np.allclose(got, values, rtol=1e-11, atol=0)
    assert significant(np.array([0.1 + 0.2])) == significant(np.array([0.3]))


def test_clusters_of_several_queries(spark):
    refs = [("q", r) for r in "abcd"] + [("p", r) for r in "xy"]
    pairs = [
        ("q", "a", "b", 0.9),
        ("q", "c", "d", 0.8),
        ("q", "a", "c", 0.1),
        ("p", "x", "y", 0.9),
        ("other", "a", "b", 1.0),
    ]
    result = cluster_refinements(
        spark.createDataFrame(pairs, schemas.SIMILARITY),
        spark.createDataFrame(refs, "query string, refinement string"),
        min_clusters=2,
    )
    groups = {}
    for query, cluster, refinement in tuples(result, "query", "cluster_id", "refinement"):
        groups.setdefault((query, cluster), []).append(refinement)
    assert groups == {("q", 0): ["a", "b"], ("q", 1): ["c", "d"], ("p", 0): ["x"], ("p", 1): ["y"]}


def test_refinement_without_any_similarity_is_kept(spark):
    refs = spark.createDataFrame([("q", r) for r in "abc"], "query string, refinement string")
    none = spark.createDataFrame([], schemas.SIMILARITY)
    assert tuples(cluster_refinements(none, refs, 1), "cluster_id", "refinement") == [
        (0, "a"),
        (1, "b"),
        (2, "c"),
    ]
