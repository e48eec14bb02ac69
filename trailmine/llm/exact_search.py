"""Exact top-k by inner product, block at a time with upper bounds.

Rows are ordered by their strongest component and cut into blocks of neighbours. A block
holds its vectors (the forward index) and the least and greatest value of each component;
with the sign of a query component one of them is the most that this component can add,
and their sum bounds every score in the block. A query visits blocks in the order of that
bound and stops when the bound of the next one is below its k-th score.

Blocks and queries are dealt to pairs of a group of blocks and a chunk of queries, both of
bounded size, so that neither all rows nor all queries are ever in one task. Each pair
gives k rows a query, from which the best are taken.

Components are whole numbers. Sums are exact: in double precision while they stay below
2 ** 53, else in integers of any size. A vector that is null or holds a null or non-finite
component, or has no id, takes no part. Shorter vectors count as followed by zeros. Of
several query rows of one id the smallest vector is used; candidates of the query's own id
are left out, other repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmine.llm.runs import ragged
from trailmine.storage import materialise

BLOCK_ROWS = 512
MOST_ROWS, MOST_QUERIES = 1 << 16, 1 << 13  # of a pair
LEAST_ROWS, LEAST_QUERIES = 1 << 12, 1 << 9
WANTED_PAIRS = 24


def whole_components(vector: str, factor: int) -> Column:
    """``floor(factor * x)`` of each component; null if the vector takes no part."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fit, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values, first = ragged(column)
    sizes = np.diff(first)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(first[:-1], sizes)] = values
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort([ids, -scores])[:k]
    return ids[order], scores[order]


def top_of_blocks(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Best rows for each query: id, row ids and scores."""
    most = int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if most < 1 << 53 else object
    strongest = np.abs(rows).argmax(1) if rows.shape[1] else np.zeros(len(rows), np.int64)
    sign = rows[np.arange(len(rows)), strongest] > 0 if rows.shape[1] else np.zeros(len(rows), bool)
    order = np.lexsort([ids, sign, strongest])
    ids, rows = ids[order], rows[order].astype(kind)
    borders = list(range(0, len(ids), BLOCK_ROWS)) + [len(ids)]
    blocks = [(ids[a:b], rows[a:b]) for a, b in zip(borders, borders[1:])]
    high, low = (np.array([f(r, axis=0) for _, r in blocks], kind) for f in (np.max, np.min))
    for query_id, query in zip(query_ids.tolist(), queries.astype(kind)):
        bounds = high @ np.maximum(query, 0) + low @ np.minimum(query, 0)
        found, scores, least = np.zeros(0, np.int64), np.zeros(0, kind), None
        for b in np.argsort(-bounds, kind="stable"):
            if least is not None and bounds[b] < least:
                break
            own_ids, own_rows = blocks[b]
            own = own_rows @ query
            good = own_ids != query_id
            if least is not None:
                good &= own >= least
            if good.any():
                found, scores = _best(np.append(found, own_ids[good]), np.append(scores, own[good]), k)
                least = scores[-1] if len(scores) == k else None
        yield query_id, found, scores


def _search(k: int, width: int):
    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            for query_id, found, scores in top_of_blocks(
                    np.asarray(left.column("vec_id").combine_chunks()), _matrix(left.column("v"), width),
                    np.asarray(right.column("vec_id").combine_chunks()), _matrix(right.column("v"), width), k):
                out[0].extend([query_id] * len(found))
                out[1].extend(found.tolist())
                out[2].extend(int(s) for s in scores)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), out)})

    return search


def _parts(rows: int, least: int, most: int) -> int:
    return max(1, -(-rows // min(most, max(least, -(-rows // WANTED_PAIRS)))))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` for each query.

    Both frames hold ``vec_id`` and ``v``, an array of whole components. Ties go to the
    smaller vec_id; fewer than ``k`` candidates are all returned.
    """
    fit = "vec_id is not null and v is not null"
    vectors = materialise(vectors.filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), "v"), "vectors")
    queries = queries.filter(fit).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("v").alias("v"))
    queries = materialise(queries, "queries")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    groups = _parts(size["n"], LEAST_ROWS, MOST_ROWS)
    asked = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    chunks = _parts(asked["n"], LEAST_QUERIES, MOST_QUERIES)
    width = max(size["width"] or 0, asked["width"] or 0)
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "v", number(groups).alias("g"), every(chunks).alias("c"))
    right = queries.select("vec_id", "v", number(chunks).alias("c"), every(groups).alias("g"))
    found = left.groupBy("g", "c").cogroup(right.groupBy("g", "c")).applyInArrow(
        _search(k, width), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
