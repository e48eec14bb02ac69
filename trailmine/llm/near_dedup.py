"""Near-duplicate documents by a multi-index Hamming join over MinHash signatures.

The signature of a document is 64 symbols of 16 bits, one for each of 64 hash orders of
its word shingles, cut into 16 chunks of 4 symbols. Two signatures that differ in at
most ``16 * 2 - 1 = 31`` symbols have, by the pigeonhole principle, a chunk with at most
one differing symbol. Each of the four places of that error is enumerated: a chunk gives
four keys of its three other symbols, and all pairs within the distance share a key. Two
documents of similarity 0.8 differ in 12.8 of 64 symbols on average; 31 is six standard
deviations away. A longer signature of 192 symbols of 8 bits, again with six standard
deviations, then thins the candidates out, and whole shingle sets decide.

No step makes all pairs of a group:

* documents of the same shingle set become one class, by a combined aggregate;
* classes that share a key are first compared with the smallest one of that key only, and
  the links found are joined to components;
* keys whose classes now lie in one component are done. For the others, signatures of
  different components are compared inside tasks, a large key in blocks, of which those of
  the pivot's component are not compared with each other. Only the classes of pairs within
  both distances go on, dealt to bounded pairs of blocks, where their whole sets are
  compared. Rows leaving a task are links of a spanning forest.

Null, empty and blank texts have no shingles and are linked with nothing. A document of
fewer words than a shingle has its whole sequence as its one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.llm.components import connected_components
from trailmine.llm.runs import binary_rows, fixed_binary, ragged, runs
from trailmine.llm.text import BLANK_SEPARATED, mix, shingles_of, slices, unmix, words_of
from trailmine.storage import materialise, scratch_path, scratch_scope

SYMBOLS, CHUNK, ERRORS = 64, 4, 1
CHUNKS = SYMBOLS // CHUNK
#: Symbols of a chunk that stand in each of its keys, also as bits.
KEPT = list(combinations(range(CHUNK), CHUNK - ERRORS))
MASKS = np.array([sum(1 << k for k in kept) for kept in KEPT])
#: Signature distance up to which every pair is found.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
LONG_SYMBOLS = 192
KEY_BLOCK = 1024  # classes of a key compared in one task with as many others
SET_BLOCK, SET_ROWS = 1 << 18, 2048  # shingles and sets of one block of whole sets

_RNG = np.random.Generator(np.random.PCG64(771))
_FLIPS = _RNG.integers(0, 1 << 63, LONG_SYMBOLS, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 1 << 63, LONG_SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def long_distance(percent: int) -> int:
    """Distance of long signatures that pairs of the similarity stay within, by six deviations."""
    p = 1 - percent / 100
    return int(LONG_SYMBOLS * p + 6 * (LONG_SYMBOLS * p * (1 - p)) ** 0.5)


def _signatures(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Short and long signatures of non-empty sets."""
    n = len(first) - 1
    short, long = np.zeros((n, SYMBOLS), np.uint16), np.zeros((n, LONG_SYMBOLS), np.uint8)
    low = 0
    while low < n:  # some 2 ** 15 hashes at once stay in the cache
        high = max(low + 1, int(np.searchsorted(first, first[low] + (1 << 15), "right")) - 1)
        part, begins = values[first[low] : first[high]], first[low:high] - first[low]
        for k in range(LONG_SYMBOLS):
            least = mix(np.minimum.reduceat((part ^ _FLIPS[k]) * _FACTORS[k], begins))
            long[low:high, k] = least >> np.uint64(56)
            if k < SYMBOLS:
                short[low:high, k] = (least >> np.uint64(16)) & np.uint64(0xFFFF)
        low = high
    return short, long


def _profiler(width: int):
    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = shingles_of(words_of(batch.column("text"), BLANK_SEPARATED), width)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            begins = np.append(first[:-1][full], len(values))
            digests = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
            short, long = _signatures(values, begins)
            if len(full):
                for seed, digest in enumerate(digests):
                    digest[full] = mix(np.add.reduceat(mix(values + np.uint64(seed)), begins[:-1]) + np.uint64(seed))
            present = np.full(len(sizes), -1)
            present[full] = np.arange(len(full))
            take = pa.array(present, mask=present < 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), *(pa.array(d.view(np.int64)) for d in digests),
                 binary_rows(short).take(take), binary_rows(long).take(take)],
                ["doc_id", "n", "cls", "digest", "short", "long"])

    return profiles


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        short = fixed_binary(batch.column("short"), "uint16", SYMBOLS).astype(np.uint64)
        cls = np.asarray(batch.column("cls"))
        for chunk in range(CHUNKS):
            symbols = short[:, chunk * CHUNK : (chunk + 1) * CHUNK]
            for kept, mask in zip(KEPT, MASKS):
                key = np.full(len(cls), chunk * 16 + mask, np.uint64)
                for k in kept:
                    key = (key << np.uint64(16)) | symbols[:, k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(key).view(np.int64)), pa.array(cls)], ["key", "cls"])


def _near(short_a, short_b, long_a, long_b, n_a, n_b, percent: int) -> np.ndarray:
    """Which pairs are within both distances and sizes."""
    near = np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent
    i = np.flatnonzero(near)
    i = i[(short_a[i] != short_b[i]).sum(1) <= DISTANCE]
    i = i[(long_a[i] != long_b[i]).sum(1) <= long_distance(percent)]
    near[:] = False
    near[i] = True
    return near


def _star_filter(percent: int):
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [(fixed_binary(batch.column(f"short_{s}"), "uint16", SYMBOLS),
                      fixed_binary(batch.column(f"long_{s}"), "uint8", LONG_SYMBOLS),
                      np.asarray(batch.column(f"n_{s}"))) for s in "ab"]
            (sa, la, na), (sb, lb, nb) = sides
            keep = pa.array(_near(sa, sb, la, lb, na, nb, percent))
            yield batch.select(["a", "b"]).filter(keep)

    return within


def _star_check(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (x, at_x), (y, at_y) = ragged(batch.column("set_a")), ragged(batch.column("set_b"))
            keep = []
            for i in range(batch.num_rows):
                a, b = x[at_x[i] : at_x[i + 1]], y[at_y[i] : at_y[i + 1]]
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return linked


def _pairs_within(short, long, n, comp, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components within both distances."""
    found = []
    for low in range(0, len(n), 64):
        high = min(len(n), low + 64)
        apart = comp[low:high, None] != comp[None, :]
        apart &= np.arange(low, high)[:, None] < np.arange(len(n))[None, :]
        i, j = np.nonzero(apart)
        i += low
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            near = _near(short[a], short[b], long[a], long[b], n[a], n[b], percent)
            found.append(np.stack([a[near], b[near]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


def _first_shared(short_a: np.ndarray, short_b: np.ndarray) -> np.ndarray:
    """The label of the first key that each pair shares."""
    same = (short_a == short_b).reshape(len(short_a), CHUNKS, CHUNK)
    chunk = (same.sum(2) >= CHUNK - ERRORS).argmax(1)
    own = same[np.arange(len(same)), chunk]
    fits = np.stack([own[:, list(kept)].all(1) for kept in KEPT], 1)
    return chunk * 16 + MASKS[fits.argmax(1)]


def _block_filter(percent: int):
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "left", "right"]):
            comp, cls, block, n = (np.asarray(run.column(c)) for c in ("component", "cls", "block", "n"))
            if (comp == comp[0]).all():
                continue
            short = fixed_binary(run.column("short"), "uint16", SYMBOLS)
            a, b = _pairs_within(short, fixed_binary(run.column("long"), "uint8", LONG_SYMBOLS), n, comp, percent)
            # A pair goes on from the first of its keys only.
            label = unmix(np.array([run.column("key")[0].as_py()], np.int64).view(np.uint64)) >> np.uint64(16 * len(KEPT[0]))
            first = _first_shared(short[a], short[b]) == int(label[0])
            a, b = a[first], b[first]
            if len(a):
                low, high = np.minimum(block[a], block[b]), np.maximum(block[a], block[b])
                rows = np.unique(np.concatenate([np.stack([low, high, cls[a]]), np.stack([low, high, cls[b]])], axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["low", "high", "cls"])

    return dealt


def _linked_pairs(values: np.ndarray, first: np.ndarray, comp: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets of different components that reach the similarity."""
    n = len(first) - 1
    sizes = np.diff(first)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = times[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(column, column[low] + 4096))
        names, place = np.unique(column[low:high], return_inverse=True)
        matrix = np.zeros((n, len(names)), np.float32)
        matrix[owner[low:high], place] = 1
        common += matrix @ matrix.T
        low = high
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    linked &= comp[:, None] != comp[None, :]
    return np.nonzero(np.triu(linked, 1))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return kept


def _block_check(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["low", "high"]):
            comp = np.asarray(run.column("component"))
            i, j = _linked_pairs(*ragged(run.column("set")), comp, percent)
            if len(i):
                pairs = np.unique(np.stack([comp[i], comp[j]]), axis=1)
                forest = _forest(*pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in forest], pa.int64()), pa.array([y for _, y in forest], pa.int64())], ["a", "b"])

    return linked


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Whole shingle sets of classes, from the text of their first document."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = shingles_of(words_of(batch.column("text"), BLANK_SEPARATED), width)
            begins = first[:-1]
            digest = np.zeros(batch.num_rows, np.uint64)
            full = np.flatnonzero(np.diff(first))
            if len(full):
                digest[full] = mix(np.add.reduceat(mix(values), begins[full]))
            own = pa.array(digest.view(np.int64) == np.asarray(batch.column("cls")))
            arrays = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), arrays], ["cls", "set"]).filter(own)

    rows = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"]))
    made = rows.select("cls", "text").mapInArrow(sets, "cls long, set array<long>")
    return made.dropDuplicates(["cls"])


def _class_components(docs: DataFrame, profiles: DataFrame, width: int, percent: int) -> DataFrame:
    """``cls, digest, rep, top``: the smallest class reachable from each class, and its first document."""
    full = profiles.filter("n > 0")
    classes = materialise(
        full.groupBy("cls", "digest").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("short").alias("short"), F.first("long").alias("long")), "classes")

    keys = classes.select("cls", "short").mapInArrow(_keys, "key long, cls long")
    shared = keys.groupBy("key").agg(F.min("cls").alias("pivot"), F.max("cls").alias("last"))
    # Written down, here and below, so that the join of a frequent key can be split.
    shared = materialise(shared.filter("pivot < last").drop("last"), "shared-keys")
    members = materialise(keys.join(shared, "key"), "members")

    signed = classes.select("cls", "n", "short", "long")
    side = lambda s: signed.select(*(F.col(c).alias(s if c == "cls" else f"{c}_{s}") for c in signed.columns))
    star = members.filter("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    near = star.join(side("a"), "a").join(side("b"), "b").mapInArrow(_star_filter(percent), "a long, b long")
    near = materialise(near, "near-pivot")

    wanted = classes.select("cls", "rep").join(members.select("cls").distinct(), "cls", "left_semi")
    sets = materialise(_sets_of(docs, wanted, width), "sets")
    to_check = (near.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")), "a")
                .join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")), "b"))
    links = materialise(to_check.mapInArrow(_star_check(percent), "a long, b long"), "pivot-links")
    found = materialise(connected_components(links), "components")

    placed = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.min_by("component", "cls").alias("main"))
    mixed = materialise(mixed.filter("x < y").select("key", "main"), "mixed-keys")
    # Classes under one pivot lie in the same blocks, as many as their sets need.
    hubs = placed.groupBy("cls", "component").agg(F.min("pivot").alias("hub"))
    grouped = materialise(hubs.join(signed, "cls"), "hubs")
    weight = grouped.groupBy("hub").agg(F.ceil(F.greatest(F.sum("n") / SET_BLOCK, F.count("*") / SET_ROWS)).alias("blocks"))
    weight = materialise(weight, "hub-weights")
    grouped = materialise(
        grouped.join(weight, "hub")
        .withColumn("block", F.xxhash64("hub", F.pmod(F.xxhash64("cls"), "blocks"))).drop("hub", "blocks"), "grouped")
    # The pivot's component, often nearly all of a key, needs no comparison inside: its
    # blocks meet those of the other classes, and these meet each other.
    sided = placed.select("key", "cls", "component").join(mixed, "key")
    inner = F.col("component") == F.col("main")
    parts = sided.groupBy("key").agg(
        F.ceil(F.count_if(inner) / KEY_BLOCK).alias("main_parts"), F.ceil(F.count_if(~inner) / KEY_BLOCK).alias("other_parts"))
    parts = materialise(parts, "key-parts")
    dealt = (sided.join(parts, "key")
             .withColumn("own", F.pmod(F.xxhash64("cls", F.lit(7)), F.when(inner, F.col("main_parts")).otherwise(F.col("other_parts"))))
             .withColumn("run", F.explode(F.when(inner, F.expr("transform(sequence(0L, other_parts - 1), o -> struct(own as left, o as right))"))
                         .otherwise(F.expr("""concat(
                             transform(sequence(0L, main_parts - 1), m -> struct(m as left, own as right)),
                             transform(filter(sequence(0L, other_parts - 1), o -> o <> own),
                                       o -> struct(-1 - least(o, own) as left, greatest(o, own) as right)))"""))))
             .select("key", "cls", "run.left", "run.right")
             .join(grouped, "cls")
             .repartition("key", "left", "right").sortWithinPartitions("key", "left", "right"))
    blocks = dealt.mapInArrow(_block_filter(percent), "low long, high long, cls long").distinct()
    checked = (blocks.join(grouped.select("cls", "component"), "cls").join(sets, "cls")
               .repartition("low", "high").sortWithinPartitions("low", "high"))
    more = materialise(checked.mapInArrow(_block_check(percent), "a long, b long"), "block-links")

    joined = connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("top"))
    final = (classes.select("cls", "digest", "rep")
             .join(found.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls"))
             .join(joined, "component", "left").withColumn("top", F.coalesce("top", "component")))
    return final.select("cls", "digest", "rep", "top")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Needs the columns ``doc_id`` and ``text``; others are ignored. Documents are linked if
    ``100 * |A and B| >= percent * |A or B|`` for their sets of ``width``-word shingles.
    ``component_id`` is the smallest doc_id reachable by links. Rows without shingles, and
    a null doc_id without partners, stand for themselves. Repeated rows are one class; of
    rows with equal doc_id all are kept or none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = materialise(
        docs.mapInArrow(_profiler(width), "doc_id long, n long, cls long, digest long, short binary, long binary"), "profiles")
    path = scratch_path(docs.sparkSession, "class-components")
    with scratch_scope(docs.sparkSession):
        final = _class_components(docs, profiles, width, percent)
        final.write.parquet(path)
    final = docs.sparkSession.read.schema(final.schema).parquet(path)
    names = final.groupBy("top").agg(F.min("rep").alias("component_id"))
    per_class = final.join(names, "top").select("cls", "digest", "component_id")
    rows = profiles.select("doc_id", "n", "cls", "digest").join(per_class, ["cls", "digest"], "left")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns.

    Of rows of equal doc_id and text one stays; rows of null doc_id stay or go together.
    """
    found = near_duplicates(docs, width, percent)
    ids = materialise(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "kept-ids")
    gone = ids.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone"))
    rows = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["__gone"]), "left_anti")
    if ids.filter("rows > 1").isEmpty():
        return rows
    return rows.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")
