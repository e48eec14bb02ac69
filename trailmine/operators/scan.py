"""One ordered pass over a log, for all users alike.

The log is range-partitioned by (user, time, sequence) into blocks of about the same size,
however its records are spread over users and times, and each block is read once in order.
A few values carry over from record to record: the user's previous record, the last place
of each of the user's queries, and the sessions that are open. So the pass knows what came
before each record and which records open a session.

Only a user whose records go on in the next block needs more, and a border between blocks
cuts one user at most. A user of two blocks has less records than these, and is read once more
as a whole. A user that fills whole blocks is not: what was carried is handed on from block to
block, the last record, the last place of each query, and the open sessions. Of the latter a
block is a function from "open since" to "last start", given by a short table; chaining the
tables of a (user, query) gives what is open when a block begins. The blocks are then independent.

Nothing depends on the number of blocks but the work of a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmine.schemas import STARTS
from trailmine.storage import materialise

RUN_KEYS = ("user_id", "query", "block")
_PASSED = (
    "block int, prev_query string, prev_doc string, same_ms bigint, same_seq bigint,"
    " is_head boolean, opens boolean, slot_rows int, slot_starts int"
)
_EXITS = "user_id bigint, query string, block int, head_ms bigint, until_ms array<bigint>, exit_ms array<bigint>"
_OPENED = "user_id bigint, query string, block int, open_ms bigint"


class Passed(NamedTuple):
    """Records with what came before them, and those that open a session.

    ``prev_query`` and ``prev_doc`` are of the user's previous record, ``same_ms`` and
    ``same_seq`` the place of the user's previous record with the same query.
    """

    records: DataFrame
    starts: DataFrame
    slots: DataFrame  # user_id, slot, n_rows, n_starts: how much one span of time holds


def _greedy(times: np.ndarray, expiry: int, last: int | None) -> tuple[list[int], int | None]:
    """Places of the records (in time order) that open a session, and the last start.

    ``last`` is the start of a session that is open before the first record.
    """
    places, at = [], 0 if last is None else int(np.searchsorted(times, last + expiry))
    while at < len(times):
        places.append(at)
        last = int(times[at])
        at = int(np.searchsorted(times, last + expiry))
    return places, last


def _shifted(column: pa.Array, first: str | None, heads: np.ndarray) -> pa.Array:
    """The value of the row before, and for the first row of a user the empty text."""
    before = pa.concat_arrays([pa.array([first], column.type), column.slice(0, len(column) - 1)])
    return pc.if_else(pa.array(heads), pa.scalar("", column.type), before)


class _Carried:
    """What goes over from one batch to the next, for the current user of a block."""

    def __init__(self) -> None:
        self.begun = False
        self.user: int | None = None
        self.query: str | None = ""
        self.doc: str | None = ""
        self.places: dict[str | None, tuple[int, int]] = {}
        self.open: dict[str | None, int] = {}


def _pass_batch(batch: pa.RecordBatch, carried: _Carried, expiry: int, seeds: set[str] | None) -> list[pa.Array]:
    n = batch.num_rows
    users, queries, docs = (batch.column(c) for c in ("user_id", "query", "doc"))
    ms, seq = (np.asarray(batch.column(c)) for c in ("ts_ms", "seq"))
    user = np.asarray(users.dictionary_encode(null_encoding="encode").indices)
    coded = queries.dictionary_encode(null_encoding="encode")
    query, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
    goes_on = carried.begun and carried.user == users[0].as_py()
    heads = np.append(not goes_on, user[1:] != user[:-1])
    run = np.cumsum(np.append(False, heads[1:]))  # 0 is the user that may go on
    prev_query, prev_doc = _shifted(queries, carried.query, heads), _shifted(docs, carried.doc, heads)

    # Rows of one user and query, in order.
    key = run * (len(names) + 1) + query
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    same = np.full(n, -1)
    same[order[1:]] = np.where(new[1:], -1, order[:-1])
    same_ms, same_seq = np.where(same >= 0, ms[same], 0), np.where(same >= 0, seq[same], 0)
    known = same >= 0
    firsts = order[new]
    if goes_on:
        for row in firsts[run[firsts] == 0].tolist():
            place = carried.places.get(names[query[row]])
            if place:
                known[row], (same_ms[row], same_seq[row]) = True, place

    may_open = pc.fill_null(pc.not_equal(queries, prev_query), False)
    if seeds is not None:
        may_open = pc.and_(may_open, pc.is_in(queries, pa.array(sorted(seeds), queries.type)))
    may_open = np.asarray(may_open)
    rows = order[may_open[order]]
    borders = np.flatnonzero(np.append(True, key[rows][1:] != key[rows][:-1])) if len(rows) else rows
    opens = np.zeros(n, bool)
    last_run, open_ = int(run[-1]), {}
    for low, high in zip(borders.tolist(), [*borders[1:].tolist(), len(rows)]):
        own = rows[low:high]
        row = own[0]
        held = carried.open.get(names[query[row]]) if goes_on and run[row] == 0 else None
        if len(own) == 1 and held is None:
            opens[row], last = True, int(ms[row])
        else:
            places, last = _greedy(ms[own], expiry, held)
            opens[own[places]] = True
        if run[row] == last_run and last is not None:
            open_[names[query[row]]] = last

    slot = ms // expiry
    borders = np.flatnonzero(np.append(True, heads[1:] | (slot[1:] != slot[:-1])))
    ends = np.append(borders[1:], n) - 1
    slot_rows, slot_starts = np.zeros(n, np.int32), np.zeros(n, np.int32)
    slot_rows[ends] = np.diff(np.append(borders, n))
    slot_starts[ends] = np.add.reduceat(opens.astype(np.int32), borders)

    places = {names[query[row]]: (int(ms[row]), int(seq[row])) for row in order[run[order] == last_run].tolist()}
    if last_run == 0 and goes_on:
        carried.places.update(places)
        carried.open.update(open_)
    else:
        carried.places, carried.open = places, open_
    carried.begun, carried.user = True, users[n - 1].as_py()
    carried.query, carried.doc = queries[n - 1].as_py(), docs[n - 1].as_py()
    empty = ~known
    return [
        prev_query, prev_doc, pa.array(same_ms, pa.int64(), mask=empty), pa.array(same_seq, pa.int64(), mask=empty),
        pa.array(heads), pa.array(opens), pa.array(slot_rows, mask=slot_rows == 0), pa.array(slot_starts, mask=slot_rows == 0)]


def _pass_over(expiry: int, seeds: set[str] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads the sorted records of a block."""
    names = [f.name for f in StructType.fromDDL(_PASSED)][1:]

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = _Carried()
        for batch in batches:
            if batch.num_rows:
                for name, column in zip(names, _pass_batch(batch, carried, expiry, seeds)):
                    batch = batch.append_column(name, column)
                yield batch

    return pass_over


def pass_log(
    log: DataFrame, expiry: int, seed_queries: Sequence[str] | DataFrame | None = None, blocks: int | None = None
) -> Passed:
    """Read ``log`` once in order; ``blocks`` is left to adaptive execution by default.

    A record opens a session if the user's previous record had another query and no session
    of its query is open; ``seed_queries`` limits the queries that may, a few names or the
    column ``query`` of a table of any size. The sessions of a query do not depend on those of
    others, so the starts are met with a table afterwards; ``slots`` counts them all.
    """
    if isinstance(seed_queries, DataFrame):
        passed = pass_log(log, expiry, None, blocks)
        seeds = seed_queries.select(F.col("query").alias("seed"))
        starts = passed.starts.join(seeds, F.col("query") == F.col("seed"), "left_semi")
        return passed._replace(starts=starts)
    order = ["user_id", "ts_ms", "seq"]
    placed = log.repartitionByRange(blocks, *order) if blocks else log.repartitionByRange(*order)
    schema = StructType([*log.schema.fields, *StructType.fromDDL(_PASSED).fields])
    in_order = _pass_over(expiry, None if seed_queries is None else set(seed_queries))

    def read(rows: DataFrame) -> DataFrame:
        ordered = rows.sortWithinPartitions(*order).withColumn("block", F.spark_partition_id())
        return ordered.mapInArrow(in_order, schema)

    # The block is not a function of the record, so it is fixed by writing it down.
    passed = materialise(read(placed), "passed-log")
    slots = passed.filter("slot_rows is not null").select(
        "user_id", F.expr(f"(ts_ms - pmod(ts_ms, {expiry})) div {expiry}").alias("slot"),
        F.col("slot_rows").alias("n_rows"), F.col("slot_starts").alias("n_starts"))
    trail = [*log.columns, "prev_query", "prev_doc", "same_ms", "same_seq"]
    twice, often = _cut_users(passed)
    whole = passed.filter(~_is_one_of(twice + often))
    if twice:
        again = read(passed.filter(_is_one_of(twice)).select(*log.columns).repartition("user_id"))
        whole = whole.unionByName(again)
    records, starts = whole.select(*trail), whole.filter("opens").select(*STARTS.names)
    if often:
        handed = _hand_on(passed.filter(_is_one_of(often)))
        records = records.unionByName(handed.select(*trail))
        starts = starts.unionByName(_cut_starts(handed.filter(_may_open(seed_queries)).select(*STARTS.names, "block"), expiry))
    return Passed(records, starts, slots)


def _is_one_of(users: list[int | None]) -> Column:
    """Whether the user is one of a few, of which there are fewer than blocks."""
    known = F.col("user_id").isin([u for u in users if u is not None])
    known = F.coalesce(known, F.lit(False))
    return known | F.col("user_id").isNull() if None in users else known


def _may_open(seed_queries: Sequence[str] | None) -> Column:
    other = F.col("query") != F.col("prev_query")
    return other if seed_queries is None else other & F.col("query").isin(list(seed_queries))


def _cut_users(passed: DataFrame) -> tuple[list[int | None], list[int | None]]:
    """The users of two blocks, and those of more."""
    place = F.struct("user_id", "ts_ms", "seq")
    ends = passed.groupBy("block").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    rows = [(r["low"]["user_id"], r["high"]["user_id"]) for r in ends.orderBy("block").collect()]
    count: dict[int | None, int] = {}
    for (_, before), (after, _) in zip(rows, rows[1:]):
        if before == after:
            count[after] = count.get(after, 0) + 1
    return [u for u, n in count.items() if n == 1], [u for u, n in count.items() if n > 1]


def _hand_on(rows: DataFrame) -> DataFrame:
    """Records of the cut users with what their earlier blocks hold."""
    place = F.struct("ts_ms", "seq")
    # One row per (user, block): a window holds as many rows as the user has blocks.
    last = F.max_by(F.struct("query", "doc"), place)
    before = F.lag("last").over(Window.partitionBy("of_user").orderBy("of_block"))
    carried = (
        rows.groupBy(F.col("user_id").alias("of_user"), F.col("block").alias("of_block"))
        .agg(last.alias("last")).select("of_user", "of_block", before.alias("carried"))
    )
    # One row per (user, query, block), so no more than blocks per window.
    before = F.lag("last").over(Window.partitionBy("in_user", "in_query").orderBy("in_block"))
    same = (
        rows.groupBy(F.col("user_id").alias("in_user"), F.col("query").alias("in_query"), F.col("block").alias("in_block"))
        .agg(F.max(place).alias("last")).select("in_user", "in_query", "in_block", before.alias("same"))
        .filter(F.col("same").isNotNull())
    )
    of_block = F.col("user_id").eqNullSafe(F.col("of_user")) & (F.col("block") == F.col("of_block"))
    in_block = (F.col("user_id").eqNullSafe(F.col("in_user")) & F.col("query").eqNullSafe(F.col("in_query"))
                & (F.col("block") == F.col("in_block")))
    takes = F.col("is_head") & F.col("carried").isNotNull()
    return rows.join(carried, of_block).join(same, in_block, "left").withColumns({
        "prev_query": F.when(takes, F.col("carried.query")).otherwise(F.col("prev_query")),
        "prev_doc": F.when(takes, F.col("carried.doc")).otherwise(F.col("prev_doc")),
        "same_ms": F.coalesce("same_ms", "same.ts_ms"),
        "same_seq": F.coalesce("same_seq", "same.seq"),
    })


def _start_finder(expiry: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the starts of rows sorted by user, query, block and time, run after run.

    Only the last start of the current run is remembered between batches. ``open_ms``,
    constant in a run, tells of a session open before it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.zeros(batch.num_rows, bool)
            for name in RUN_KEYS:
                # Numbers for the values; null is a value of its own.
                code = np.asarray(batch.column(name).dictionary_encode(null_encoding="encode").indices)
                changed[1:] |= code[1:] != code[:-1]
            borders = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
            times = np.asarray(batch.column("ts_ms"))
            kept: list[int] = []
            for low, high in zip(borders, borders[1:]):
                own = tuple(batch.column(name)[low].as_py() for name in RUN_KEYS)
                if own != key:
                    key, last = own, batch.column("open_ms")[low].as_py()
                places, last = _greedy(times[low:high], expiry, last)
                kept.extend(low + p for p in places)
            yield batch.select(STARTS.names).take(pa.array(kept, pa.int64()))

    return find


def exit_function(times: np.ndarray, expiry: int) -> tuple[int, np.ndarray, np.ndarray]:
    """What the times of a block make of a session that is open before it.

    Returns the last start if none is open, and the last start by the time at which the
    open session expires: entry i holds for times up to ``until[i]``. Past the last
    entry the block opens no session.
    """
    n = len(times)
    follower = np.searchsorted(times, times + expiry)
    # Last start of the chain that begins at each record, by doubling the steps.
    end = np.where(follower < n, follower, np.arange(n))
    while (end != end[end]).any():
        end = end[end]
    last = times[end]
    # What is open before began before the first record.
    possible = min(int(np.searchsorted(times, times[0] + expiry, "right")) + 1, n)
    # Of neighbours with the same exit only the latest is kept.
    keep = np.append(last[1:possible] != last[: possible - 1], True)
    return int(last[0]), times[:possible][keep], last[:possible][keep]


def _summaries(expiry: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def summarise(key: tuple, rows: pa.Table) -> pa.Table:
        times = np.sort(np.asarray(rows.column("ts_ms").combine_chunks()))
        head, until, exits = exit_function(times, expiry)
        own = [x.as_py() for x in key]
        return pa.table({
            "user_id": pa.array([own[0]], pa.int64()), "query": pa.array([own[1]], pa.string()),
            "block": pa.array([own[2]], pa.int32()), "head_ms": pa.array([head], pa.int64()),
            "until_ms": pa.array([until.tolist()], pa.list_(pa.int64())),
            "exit_ms": pa.array([exits.tolist()], pa.list_(pa.int64())),
        })

    return summarise


def _chain(expiry: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def chain(key: tuple, rows: pa.Table) -> pa.Table:
        """One row per block of the pair, at most as many as there are blocks."""
        rows = rows.sort_by("block")
        last, opened = None, []
        for head, until, exits in zip(*(rows.column(c).to_pylist() for c in ("head_ms", "until_ms", "exit_ms"))):
            opened.append(last)
            place = None if last is None else int(np.searchsorted(until, last + expiry))
            if place is None:
                last = head
            elif place < len(until):
                last = exits[place]
        return rows.select(["user_id", "query", "block"]).append_column("open_ms", pa.array(opened, pa.int64()))

    return chain


def _cut_starts(candidates: DataFrame, expiry: int) -> DataFrame:
    """Session starts of the cut users, block by block, once it is known what is open before each."""
    pair = ["user_id", "query"]
    several = candidates.groupBy(*pair).agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
    summaries = (
        candidates.join(several.select(*pair), pair, "left_semi")
        .groupBy(*pair, "block").applyInArrow(_summaries(expiry), _EXITS)
    )
    opened = summaries.groupBy(*pair).applyInArrow(_chain(expiry), _OPENED)
    renamed = opened.select(*(F.col(c).alias(f"of_{c}") for c in RUN_KEYS), "open_ms")
    same_run = F.col("user_id").eqNullSafe(F.col("of_user_id")) & (F.col("query") == F.col("of_query")) & (F.col("block") == F.col("of_block"))
    told = candidates.join(renamed, same_run, "left").repartition(*RUN_KEYS)
    ordered = told.sortWithinPartitions(*RUN_KEYS, "ts_ms", "seq").select(*STARTS.names, "block", "open_ms")
    return ordered.mapInArrow(_start_finder(expiry), STARTS)
