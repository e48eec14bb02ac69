"""Random walk from the refinements of a query to the clicked documents.

From a refinement the walk goes to a co-occurring refinement (weight 1 - epsilon),
to a document clicked for it (weight epsilon) or changes the topic (weight 1/N for
N refinements); the three weights are scaled to sum to one. Documents and topic
change absorb the walk.

A query has at most as many refinements as the top-k step keeps, so its
refinement-to-refinement matrix is small and fits one group. Its documents are
not bounded and stay in rows that Spark distributes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmine.operators.cooccurrence import symmetric_co_occ
from trailmine.params import (
    DOC_ROWS_PER_TASK,
    DOUBLINGS,
    ENTRIES_PER_TASK,
    EPSILON,
    MAX_REFINEMENTS,
    VECTOR_ROWS_PER_TASK,
)
from trailmine.storage import materialise

# Destination name of the topic change.
TOPIC = ""
_FACTOR = "query string, refinements array<string>, reach array<double>"
_VECTORS = "query string, refinement string, doc string, p double"
_PRODUCTS = "query string, refinement string, co_refinement string, largest double, total double"
# Which entry product a similarity mode divides by the norms.
PRODUCT_OF_MODE = {"max_product": "largest", "cosine": "total"}
# Document columns multiplied at a time inside a task.
_COLUMN_BATCH = 4096
# Work on a pair of entries by index, over that on a cell of a column.
_PAIR_COST = 8


def row_normalise(df: DataFrame, row_keys: Sequence[str], value: str) -> DataFrame:
    """Divide ``value`` by its row sum, as column ``p``; rows that sum to zero stay zero.

    The sums are aggregated and joined back, so a very long row is not pulled
    into one task.
    """
    keys = list(row_keys)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("row_sum"))
    p = F.when(F.col("row_sum") > 0, F.col(value) / F.col("row_sum")).otherwise(F.lit(0.0))
    return df.join(sums, keys).withColumn("p", p.cast("double")).drop("row_sum")


def reference_rows(co_occ: DataFrame, doc_counts: DataFrame) -> DataFrame:
    """One row per refinement that takes part in the walk.

    Columns: ``query, refinement, pair_sum, doc_sum`` (null without clicks),
    ``n_refs`` and ``query_docs`` (refinements and document rows of the query). A
    query takes part if it has a co-occurrence and a click; of its refinements
    those with a co-occurrence.
    """
    pairs = co_occ.select(
        "query",
        F.explode(F.array("refinement", "co_refinement")).alias("refinement"),
        F.col("count").alias("pair"),
        F.lit(None).cast("bigint").alias("doc"),
    )
    docs = doc_counts.select(
        "query",
        "refinement",
        F.lit(None).cast("bigint").alias("pair"),
        F.col("count").alias("doc"),
    )
    of_query = Window.partitionBy("query")
    in_walk = F.col("pair_sum").isNotNull()
    return (
        pairs.unionByName(docs)
        .groupBy("query", "refinement")
        .agg(
            F.sum("pair").alias("pair_sum"),
            F.sum("doc").alias("doc_sum"),
            F.count("doc").alias("docs"),
        )
        .withColumns(
            {
                "n_refs": F.count("pair_sum").over(of_query),
                "query_docs": F.sum(F.when(in_walk, F.col("docs")).otherwise(0)).over(of_query),
                "query_clicks": F.count("doc_sum").over(of_query),
            }
        )
        .filter(in_walk & (F.col("query_clicks") > 0))
        .drop("docs", "query_clicks")
    )


def _scale(epsilon: float) -> Column:
    """Sum of the weights of a refinement before they are scaled to one."""
    clicked = F.when(F.col("doc_sum").isNotNull(), F.lit(epsilon)).otherwise(F.lit(0.0))
    return (1 - epsilon) + clicked + 1 / F.col("n_refs")


def ref_steps(co_occ: DataFrame, rows: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Steps between refinements, ``query, src, dst, p``, of the refinements in ``rows``."""
    weight = (1 - epsilon) * (F.col("count") / F.col("pair_sum"))
    return (
        symmetric_co_occ(co_occ)
        .join(rows, ["query", "refinement"])
        .select(
            "query",
            F.col("refinement").alias("src"),
            F.col("co_refinement").alias("dst"),
            (weight / _scale(epsilon)).alias("p"),
        )
    )


def doc_steps(doc_counts: DataFrame, rows: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Steps to documents, ``query, src, dst, p``, of the refinements in ``rows``."""
    weight = epsilon * (F.col("count") / F.col("doc_sum"))
    return doc_counts.join(rows, ["query", "refinement"]).select(
        "query",
        F.col("refinement").alias("src"),
        F.col("doc").alias("dst"),
        (weight / _scale(epsilon)).alias("p"),
    )


def transition_table(
    co_occ: DataFrame, doc_counts: DataFrame, epsilon: float = EPSILON
) -> DataFrame:
    """Step probabilities ``query, src, dst, kind, p``; kind is ``ref``, ``doc`` or ``topic``.

    The absorbing states have no rows.
    """
    rows = materialise(reference_rows(co_occ, doc_counts), "walk-refs")
    to_topic = rows.select(
        "query",
        F.col("refinement").alias("src"),
        F.lit(TOPIC).alias("dst"),
        (1 / F.col("n_refs") / _scale(epsilon)).alias("p"),
    )
    steps = {
        "ref": ref_steps(co_occ, rows, epsilon),
        "doc": doc_steps(doc_counts, rows, epsilon),
        "topic": to_topic,
    }
    parts = [
        df.select("query", "src", "dst", F.lit(kind).alias("kind"), "p")
        for kind, df in steps.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def steps_of(transitions: DataFrame, kind: str) -> DataFrame:
    return transitions.filter(F.col("kind") == kind).select("query", "src", "dst", "p")


def renewed(df: DataFrame) -> DataFrame:
    """``df`` with columns of their own, so that it can meet a frame of the same origin."""
    return df.toDF(*df.columns)


def check_size(n: int) -> None:
    """Refuse a query of more refinements than one group handles as a full matrix."""
    if n > MAX_REFINEMENTS:
        raise ValueError(f"{n} refinements of a query; at most {MAX_REFINEMENTS} are handled, see refs_per_query")


def reach_matrix(steps: pd.DataFrame, doublings: int) -> tuple[pd.Index, np.ndarray]:
    """Refinement names and the sum of the first 2**doublings powers of the step matrix."""
    names = pd.Index(sorted(set(steps["src"]) | set(steps["dst"])), dtype=object)
    check_size(len(names))
    power = np.zeros((len(names), len(names)))
    power[names.get_indexer(steps["src"]), names.get_indexer(steps["dst"])] = steps["p"]
    reach = np.eye(len(names))
    for _ in range(doublings):
        reach = reach + power @ reach
        power = power @ power
    return names, reach


def absorption_factors(
    transitions: DataFrame, doublings: int = DOUBLINGS
) -> tuple[DataFrame, DataFrame]:
    """The absorption vectors as a product: reach matrices, and steps to documents.

    The first table has one row per query, ``query, refinements, reach``; ``reach`` holds
    the matrix of :func:`reach_matrix` row by row. The second is ``query, src, dst, p``.
    """

    def packed(steps: pd.DataFrame) -> pd.DataFrame:
        names, reach = reach_matrix(steps, doublings)
        return pd.DataFrame(
            {"query": steps["query"].iloc[:1], "refinements": [list(names)], "reach": [reach.ravel()]}
        )

    to_refs = steps_of(transitions, "ref")
    return to_refs.groupBy("query").applyInPandas(packed, _FACTOR), steps_of(transitions, "doc")


def vectors_of_factors(
    reach: DataFrame, to_docs: DataFrame, entries_per_task: int = ENTRIES_PER_TASK
) -> DataFrame:
    """``query, refinement, doc, p`` from the tables of :func:`absorption_factors`.

    The documents of a query are dealt to tasks by hash, as many parts as keep the
    entries of one below ``entries_per_task``; each part multiplies its steps by the whole
    reach matrix. So an entry is complete where it is formed, and is never shuffled.
    """
    counted = to_docs.groupBy("query").agg(F.count("*").alias("n"))
    entries = F.col("n") * F.size("refinements")
    last_part = F.call_function("div", entries, F.lit(entries_per_task))
    # Read three times: counted, dealt, and copied to all parts of its query.
    reach = materialise(reach, "reach")
    parts = materialise(counted.join(reach, "query").select("query", last_part.alias("last_part")), "walk-parts")
    dealt, every_part = _dealt(to_docs, parts, "dst"), _copied(reach, parts)

    def entries_of(factor: pd.DataFrame, clicks: pd.DataFrame) -> pd.DataFrame:
        if factor.empty or clicks.empty:
            none = np.array([], object)
            return pd.DataFrame({"query": none, "refinement": none, "doc": none, "p": np.zeros(0)})
        names = pd.Index(factor["refinements"].iloc[0], dtype=object)
        weights = np.asarray(factor["reach"].iloc[0], float).reshape(len(names), len(names))
        column, docs = pd.factorize(clicks["dst"].to_numpy(object))
        row = names.get_indexer(clicks["src"])
        steps, present = np.zeros((2, len(names), len(docs)))
        steps[row, column], present[row, column] = clicks["p"], 1
        # However small an entry, it has a row if there is a path.
        i, j = np.nonzero((weights > 0) @ present)
        return pd.DataFrame(
            {
                "query": np.repeat(factor["query"].to_numpy(object)[:1], len(i)),
                "refinement": names.to_numpy()[i],
                "doc": docs[j],
                "p": (weights @ steps)[i, j],
            }
        )

    return (
        every_part.groupBy("query", "part")
        .cogroup(dealt.groupBy("query", "part"))
        .applyInPandas(entries_of, _VECTORS)
    )


def absorption_vectors(transitions: DataFrame, doublings: int = DOUBLINGS) -> DataFrame:
    """Probability of ending in each document within 2**doublings steps, per refinement.

    A refinement without a path to a document has no rows.
    """
    return vectors_of_factors(*absorption_factors(transitions, doublings))


def _dealt(rows: DataFrame, parts: DataFrame, doc: str) -> DataFrame:
    """``rows`` with the ``part`` of their document, of the parts 0 to ``last_part`` of the query.

    The join is on the query alone. Without the explicit repartitioning Spark would leave all
    parts of a query in one task.
    """
    part = F.pmod(F.xxhash64(doc), F.col("last_part") + 1)
    return renewed(rows.join(parts, "query").withColumn("part", part)).repartition("query", "part")


def _copied(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` once for each part of their query."""
    every_part = F.explode(F.sequence(F.lit(0).cast("bigint"), "last_part"))
    return rows.join(parts, "query").withColumn("part", every_part).repartition("query", "part")


def pair_products(
    ref: np.ndarray, doc: np.ndarray, p: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Largest and summed products of the entries of all pairs of ``n`` refinements.

    An entry ``p`` has the place ``ref`` of its refinement and the number ``doc`` of its
    document. Only the pairs above the diagonal and on it are filled; a pair without a
    common document has -1 as its largest product. Documents of few entries, usually nearly
    all, are paired entry by entry; for the others whole columns are multiplied in batches.
    """
    order = np.lexsort((ref, doc))
    ref, doc, p = ref[order], doc[order], p[order]
    largest, total = np.full(n * n, -1.0), np.zeros(n * n)

    def add(a: np.ndarray, b: np.ndarray) -> None:
        pair, product = ref[a] * n + ref[b], p[a] * p[b]
        np.maximum.at(largest, pair.ravel(), product.ravel())
        np.add.at(total, pair.ravel(), product.ravel())

    add(np.arange(len(ref)), np.arange(len(ref)))
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    sizes = np.diff(starts, append=len(doc))
    light = _PAIR_COST * sizes**2 < n**2
    for size in np.unique(sizes[light & (sizes > 1)]):
        places = starts[light & (sizes == size), None] + np.arange(size)
        for apart in range(1, size):
            add(places[:, :-apart], places[:, apart:])

    largest, total = largest.reshape(n, n), total.reshape(n, n)
    heavy = np.flatnonzero(~light & (sizes > 1))
    for low in range(0, len(heavy), _COLUMN_BATCH):
        own = heavy[low : low + _COLUMN_BATCH]
        column = np.repeat(np.arange(len(own)), sizes[own])
        place = np.repeat(starts[own] - np.cumsum(sizes[own]) + sizes[own], sizes[own]) + np.arange(len(column))
        vectors = np.full((n, len(own)), np.nan)
        vectors[ref[place], column] = p[place]
        filled = np.nan_to_num(vectors, nan=0.0)
        total += np.triu(filled @ filled.T, 1)  # the diagonal is complete already
        for i in range(n - 1):
            products = np.fmax.reduce(vectors[i + 1 :] * vectors[i], axis=1, initial=-1)
            largest[i, i + 1 :] = np.maximum(largest[i, i + 1 :], products)
    return largest, total


def products_of_vectors(vectors: DataFrame, rows_per_task: int = VECTOR_ROWS_PER_TASK) -> DataFrame:
    """The result of :func:`vector_products` from written-down vectors.

    The documents of a query are dealt to tasks by hash in parts of about ``rows_per_task``
    entries. A task writes one row per pair of refinements, however many documents they share.
    """
    entries = vectors.filter(F.col("p") > 0).select("query", "refinement", "doc", "p")
    last_part = F.call_function("div", F.count("*"), F.lit(rows_per_task))
    parts = materialise(entries.groupBy("query").agg(last_part.alias("last_part")), "vector-parts")

    def products(own: pd.DataFrame) -> pd.DataFrame:
        names, ref = np.unique(own["refinement"].to_numpy(object), return_inverse=True)
        check_size(len(names))
        largest, total = pair_products(ref, pd.factorize(own["doc"])[0], own["p"].to_numpy(), len(names))
        i, j = np.nonzero(largest >= 0)
        return pd.DataFrame(
            {
                "query": own["query"].iloc[0],
                "refinement": names[i],
                "co_refinement": names[j],
                "largest": largest[i, j],
                "total": total[i, j],
            }
        )

    return (
        _dealt(entries, parts, "doc")
        .groupBy("query", "part")
        .applyInPandas(products, _PRODUCTS)
        .groupBy("query", "refinement", "co_refinement")
        .agg(F.max("largest").alias("largest"), F.sum("total").alias("total"))
    )


def ref_similarity(
    vectors: DataFrame, mode: str = "max_product", rows_per_task: int = VECTOR_ROWS_PER_TASK
) -> DataFrame:
    """Similarity of two refinements of a query by their absorption vectors.

    ``max_product`` is the largest product of two entries over the product of the
    norms, ``cosine`` the sum of the products over it. Pairs without a common
    document are absent. The smaller refinement comes first.
    """
    products = products_of_vectors(vectors, rows_per_task)
    return similarity_from_products(materialise(products, "products"), mode)


def entry_products(
    names: pd.Index, reach: np.ndarray, clicks: pd.DataFrame
) -> tuple[np.ndarray, np.ndarray]:
    """Largest and summed products of the vector entries of all refinement pairs.

    Only the pairs above the diagonal and on it are filled. ``clicks`` are the
    document steps that count. Documents clicked for one refinement only, usually
    nearly all, differ by a factor: the largest step and the sum of the squared
    steps stand for all of them. The others are handled in batches.
    """
    n = len(names)
    ref = names.get_indexer(clicks["src"])
    doc = pd.factorize(clicks["dst"])[0]
    p = clicks["p"].to_numpy()
    alone = np.bincount(doc)[doc] == 1

    squares = np.bincount(ref[alone], weights=p[alone] ** 2, minlength=n)
    strongest = np.zeros(n)
    np.maximum.at(strongest, ref[alone], p[alone])
    total = (reach * squares) @ reach.T
    largest = np.zeros((n, n))

    def add_largest(vectors: np.ndarray) -> None:
        for i in range(n):
            products = (vectors[i:] * vectors[i]).max(axis=1, initial=0)
            largest[i, i:] = np.maximum(largest[i, i:], products)

    add_largest((reach * strongest)[:, strongest > 0])
    doc, docs = pd.factorize(doc[~alone])
    ref, p = ref[~alone], p[~alone]
    for low in range(0, len(docs), _COLUMN_BATCH):
        part = (doc >= low) & (doc < low + _COLUMN_BATCH)
        steps = np.zeros((n, min(_COLUMN_BATCH, len(docs) - low)))
        steps[ref[part], doc[part] - low] = p[part]
        vectors = reach @ steps
        total += vectors @ vectors.T
        add_largest(vectors)
    return largest, np.triu(total)


def vector_products(
    to_refs: DataFrame,
    to_docs: DataFrame,
    doublings: int = DOUBLINGS,
    doc_rows_per_task: int = DOC_ROWS_PER_TASK,
) -> DataFrame:
    """Entry products of all refinement pairs: ``query, refinement, co_refinement, largest, total``.

    The pair of a refinement with itself is included (its ``total`` is the squared
    norm). The vectors are not written out: the documents of a query are dealt to
    tasks by hash, each task forms its part of the vectors, and largest and summed
    products of the parts are combined. A query with very many documents gets
    proportionally many parts.
    """
    last_part = F.call_function("div", F.count("*"), F.lit(doc_rows_per_task))
    parts = materialise(to_docs.groupBy("query").agg(last_part.alias("last_part")), "walk-parts")
    keys = ["query", "part"]
    dealt, copied = _dealt(to_docs, parts, "dst"), _copied(to_refs, parts)

    def products(steps: pd.DataFrame, clicks: pd.DataFrame) -> pd.DataFrame:
        names, reach = reach_matrix(steps, doublings)
        largest, total = entry_products(names, reach, clicks)
        i, j = np.nonzero(total)
        return pd.DataFrame(
            {
                "query": np.repeat(steps["query"].to_numpy()[:1], len(i)),
                "refinement": names[i],
                "co_refinement": names[j],
                "largest": largest[i, j],
                "total": total[i, j],
            }
        )

    return (
        copied.groupBy(*keys)
        .cogroup(dealt.groupBy(*keys))
        .applyInPandas(products, _PRODUCTS)
        .groupBy("query", "refinement", "co_refinement")
        .agg(F.max("largest").alias("largest"), F.sum("total").alias("total"))
    )


def similarity_from_products(products: DataFrame, mode: str = "max_product") -> DataFrame:
    """The result of :func:`ref_similarity` from entry products."""
    value = PRODUCT_OF_MODE[mode]
    itself = F.col("refinement") == F.col("co_refinement")
    norms = products.filter(itself).select(
        "query", F.col("refinement").alias("name"), F.sqrt("total").alias("norm")
    )
    left = norms.select("query", F.col("name").alias("refinement"), F.col("norm").alias("a"))
    right = norms.select("query", F.col("name").alias("co_refinement"), F.col("norm").alias("b"))
    return (
        products.filter(~itself)
        .join(left, ["query", "refinement"])
        .join(right, ["query", "co_refinement"])
        .select(
            "query",
            "refinement",
            "co_refinement",
            (F.col(value) / (F.col("a") * F.col("b"))).alias("similarity"),
        )
    )
