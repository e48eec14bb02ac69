"""Vectors as short codes: product quantisation with integer codebooks, entries found by GNAT.

Each component becomes ``floor(factor * x)``. A vector is cut into equal consecutive parts,
each with a codebook of entries. A round gives every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and moves each entry to the componentwise
``floor(sum / count)`` of its parts; entries without parts stay. After the last round all
parts are given out once more.

The nearest entry is found in a geometric near-neighbour access tree over the entries. A node
has split points; every other entry belongs to its nearest split point, and for each pair of a
split point and a child the least and greatest distance from the one to the entries of the
other are stored. With ``d`` from a query to a split point and ``r`` to its best entry so far,
a child goes, with all below it, if its range lies wholly outside ``[d - r, d + r]``. Roots are
rounded outwards and the border itself never goes, so no nearest entry, and none equally near,
is lost; distances decide as whole numbers. Queries of a batch walk the tree together.

Only codebooks go through the driver: ``parts * entries`` rows of sums a round, combined per
batch and by Spark. They are bounded, as is the sample they start from: the vectors of the
smallest ids.

Vectors that are null or hold a null or non-finite component take no part. Components beyond
2 ** 60 count as 2 ** 60. Vectors shorter than the longest, or than a multiple of the number
of parts, count as followed by zeros; empty ones are all zeros. Rows of equal or null ids count
each; a null id ranks last. With fewer vectors than entries there are as many entries as
vectors, and without vectors no rows. Sums beyond a long are given as the greatest long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.llm.runs import ragged
from trailmine.llm.sending import send
from trailmine.llm.text import widened
from trailmine.storage import materialise

ENTRIES, PARTS, ROUNDS, FACTOR = 256, 4, 4, 1024
SPLITS, LEAF = 16, 24  # split points of a node; entries that make no node of their own
SLACK = 1e-15  # relative, some four times what roots and differences are rounded by
ROWS = 1 << 12  # vectors handled at once
GREATEST = (1 << 63) - 1


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above the roots of whole numbers."""
    root = np.sqrt(squares.astype(np.float64))
    return root * (1 - SLACK), root * (1 + SLACK)


def exact_kind(*matrices: np.ndarray) -> type:
    """The type in which squared distances of these rows are exact."""
    most = max((int(np.abs(m).max(initial=0)) for m in matrices), default=0)
    width = max((m.shape[1] for m in matrices), default=1)
    return np.float64 if 4 * most * most * max(1, width) < 1 << 53 else object


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact in the type of both."""
    return (rows * rows).sum(1)[:, None] + (entries * entries).sum(1)[None, :] - 2 * (rows @ entries.T)


@dataclass
class _Node:
    splits: np.ndarray  # indexes of entries
    low: np.ndarray  # [split, child]: no entry of the child is nearer to the split point
    high: np.ndarray  # nor farther
    children: list = field(default_factory=list)  # a node, indexes of a leaf, or None


@dataclass
class Nearest:
    """Rows and the best entry of each so far."""

    rows: np.ndarray
    index: np.ndarray
    distance: np.ndarray
    reach: np.ndarray  # no less than the root of the distance
    looked_at: int = 0  # distances computed


class Gnat:
    """A tree over the entries of one codebook; build it in the type of :func:`exact_kind`."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.twice, self.squares = -2 * entries.T, (entries * entries).sum(1)
        self.root = self._build(np.arange(len(entries)))

    def _build(self, members: np.ndarray) -> _Node | np.ndarray | None:
        if len(members) <= LEAF:
            return members if len(members) else None  # in ascending order
        # Split points far from each other: each is the entry farthest from those before.
        own = self.entries[members]
        splits = [0]
        apart = squared(own, own[:1])[:, 0]
        while len(splits) < SPLITS and apart.max() > 0:
            splits.append(int(np.argmax(apart)))
            apart = np.minimum(apart, squared(own, own[splits[-1:]])[:, 0])
        rest = np.ones(len(members), bool)
        rest[splits] = False
        table = squared(own, own[splits])
        owner = np.argmin(table, axis=1)
        low, high = np.zeros((len(splits),) * 2), np.zeros((len(splits),) * 2)
        node = _Node(members[splits], low, high)
        for child, place in enumerate(splits):
            inside = (owner == child) & rest
            with_split = table[inside | (np.arange(len(members)) == place)]
            low[:, child], high[:, child] = _roots(with_split.min(0))[0], _roots(with_split.max(0))[1]
            # Equal entries only cannot be divided further.
            node.children.append(self._build(members[inside]) if len(splits) > 1 else members[inside])
        return node

    def nearest(self, rows: np.ndarray) -> Nearest:
        """The nearest entry of each row, of equally near ones that of the lowest index."""
        n = len(rows)
        best = Nearest(rows, np.full(n, len(self.entries)), np.full(n, np.inf, rows.dtype), np.full(n, np.inf))
        self._search(self.root, (rows * rows).sum(1), np.arange(n), best)
        return best

    def _offer(self, squares: np.ndarray, who: np.ndarray, members: np.ndarray, best: Nearest) -> np.ndarray:
        """Compare entries; gives the distances to the first one."""
        table = best.rows[who] @ self.twice[:, members]
        table += self.squares[members]
        table += squares[who][:, None]
        best.looked_at += table.size
        place = np.argmin(table, axis=1)
        distance, index = table[np.arange(len(who)), place], members[place]
        old = best.distance[who]
        better = (distance < old) | ((distance == old) & (index < best.index[who]))
        if better.any():
            changed = who[better]
            best.distance[changed], best.index[changed] = distance[better], index[better]
            best.reach[changed] = _roots(distance[better])[1]
        return table[:, 0]

    def _search(self, node: _Node | np.ndarray | None, squares: np.ndarray, who: np.ndarray, best: Nearest) -> None:
        if node is None or not len(who):
            return
        if isinstance(node, np.ndarray):
            self._offer(squares, who, node, best)
            return
        # How far each child is from each query at least, by the split points asked so far.
        gap = np.zeros((len(who), len(node.splits)))
        for k in range(len(node.splits)):
            asked = np.flatnonzero(gap[:, k] <= best.reach[who])
            if not len(asked):
                continue
            near, far = (x[:, None] for x in _roots(self._offer(squares, who[asked], node.splits[k : k + 1], best)))
            outside = np.maximum(node.low[k] - far, near - node.high[k])
            outside -= SLACK * (far + node.high[k])
            gap[asked] = np.maximum(gap[asked], outside)
        for k, child in enumerate(node.children):
            self._search(child, squares, who[gap[:, k] <= best.reach[who]], best)


@dataclass
class Codebooks:
    """Whole-number entries by part, and their trees, which are built where they are used."""

    entries: np.ndarray  # [part, entry, component]
    trees: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"entries": self.entries, "trees": {}}

    def nearest(self, part: int, rows: np.ndarray) -> Nearest:
        own = self.entries[part]
        kind = exact_kind(own, rows)
        tree = self.trees.get((part, kind))
        if tree is None:
            tree = self.trees[part, kind] = Gnat(own.astype(kind))
        return tree.nearest(rows.astype(kind))


def _usable(vector: str) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _whole(vector: str, factor: int) -> Column:
    edge = F.lit(float(1 << 60))
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * factor, -edge), edge)).cast("long"))


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for begin in range(0, batch.num_rows, ROWS):
        own = batch.slice(begin, ROWS)
        values, first = ragged(own.column("__v"))
        sizes = np.diff(first)
        out = np.zeros((len(sizes), width), np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(values)) - np.repeat(first[:-1], sizes)] = values
        yield own, out


def _sums(books: Callable[[], Codebooks], width: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each entry: how many parts it has in these rows, and their sum."""
        codebooks = books()
        parts, n, size = codebooks.entries.shape
        counts, totals = np.zeros((parts, n), np.int64), np.zeros((parts, n, size), object)
        for batch in batches:
            for _, rows in _matrices(batch, width):
                for part in range(parts):
                    own = rows[:, part * size : (part + 1) * size]
                    index = codebooks.nearest(part, own).index
                    order = np.argsort(index, kind="stable")
                    entry, begins = np.unique(index[order], return_index=True)
                    kind = np.int64 if int(np.abs(own).max(initial=0)) < 1 << 50 else object
                    counts[part, entry] += np.diff(np.append(begins, len(order)))
                    totals[part, entry] += np.add.reduceat(own[order].astype(kind), begins, axis=0).astype(object)
        part, entry = np.nonzero(counts)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64())]
        columns += [pa.array([str(x) for x in totals[part, entry, k]], pa.string()) for k in range(size)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *(f"c{k}" for k in range(size))])

    return sums


def _refine(vectors: DataFrame, codebooks: Codebooks, width: int) -> Codebooks:
    """The codebooks after one round."""
    size = codebooks.entries.shape[2]
    names = [f"c{k}" for k in range(size)]
    schema = "part int, entry int, n long" + "".join(f", {c} string" for c in names)
    books = send(vectors.sparkSession, codebooks)
    found = vectors.select("__v").mapInArrow(_sums(books, width), schema).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names))
    entries = codebooks.entries.copy()
    for row in found.collect():  # at most one row for each entry of each part
        entries[row["part"], row["entry"]] = [int(row[c]) // row["n"] for c in names]
    return Codebooks(entries)


def _coded(books: Callable[[], Codebooks], width: int) -> Callable:
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = books()
        parts, n, size = codebooks.entries.shape
        digits = max(2, len(f"{n - 1:x}"))
        for batch in batches:
            for own, rows in _matrices(batch, width):
                found = [codebooks.nearest(p, rows[:, p * size : (p + 1) * size]) for p in range(parts)]
                names = ["".join(f"{x:0{digits}x}" for x in row) for row in zip(*(f.index.tolist() for f in found))]
                errors = [min(GREATEST, sum(int(x) for x in row)) for row in zip(*(f.distance.tolist() for f in found))]
                own = own.drop_columns(["__v"])
                yield own.append_column("code", pa.array(names, pa.string())).append_column("error", pa.array(errors, pa.int64()))

    return coded


@dataclass
class Coded:
    rows: DataFrame
    codebooks: Codebooks


def encode_vectors(
    vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR,
) -> Coded:
    """Fit codebooks to all vectors and code them.

    ``rows`` are those of the vectors that take part, without ``vector``, with ``code``, the
    indexes of the entries in hex digits (two each for up to 256 entries), and ``error``, the
    squared distances summed over parts. Columns of these names are replaced.
    """
    kept = vectors.filter(F.col(vector).isNotNull() & _usable(vector))
    others = [c for c in vectors.columns if c not in (vector, "code", "error")]
    whole = materialise(kept.select(*others, _whole(vector, factor).alias("__v")), "whole-vectors")
    longest = whole.agg(F.max(F.size("__v"))).first()[0]
    if longest is None:
        return Coded(whole.drop("__v").withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}), Codebooks(np.zeros((parts, 0, 0), np.int64)))
    size = -(-longest // parts)
    width = size * parts
    chosen = whole.orderBy(F.col(id_column).asc_nulls_last(), "__v").limit(entries).select("__v").collect()
    start = np.zeros((len(chosen), width), np.int64)
    for k, row in enumerate(chosen):
        start[k, : len(row["__v"])] = row["__v"]
    codebooks = Codebooks(start.reshape(len(chosen), parts, size).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        codebooks = _refine(whole, codebooks, width)
    books = send(whole.sparkSession, codebooks)
    return Coded(whole.mapInArrow(_coded(books, width), widened(whole.drop("__v"), "code string, error long")), codebooks)
