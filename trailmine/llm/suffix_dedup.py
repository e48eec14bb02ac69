"""Repeated byte strings across documents, by suffix arrays of shards that are then merged.

A window is a string of ``width`` bytes inside one document. It goes if the same window also
starts in a document of a smaller doc_id; all bytes of such windows are removed.

Documents are dealt to shards of bounded size by hash, so the text is shuffled once.

1. Each window has a key: the least hash of the 16-byte strings in it. Equal windows have
   equal keys, and neighbours mostly share theirs, so a shard has about one key for 18 bytes.
   Buckets of keys tell each shard which of its keys other shards have too. Windows of other
   keys repeat inside the shard at most.
2. Each shard builds the suffix array (Larsson-Sadakane) of its stretches with keys that
   several of its documents have, and the common prefixes of neighbours (Kasai). Windows that
   agree in ``width`` bytes lie side by side; all but those of the smallest doc_id go. What
   remains and has a key of other shards is sent to the bucket of its key: one document at
   most for each window, however many copies the shard holds.
3. Shards are merged bucket by bucket: windows are named by a hash, the sorted names of all
   shards are merged, and each shard finds its windows there by binary search. Equal names are
   compared byte by byte. Again all but those of the smallest doc_id go. Of very many shards,
   ``FAN_IN`` are merged at a time, and what remains of them is merged again.
4. Each shard cuts what goes out of its documents.

Null and empty texts have no windows and stay as they are. A null doc_id counts as the smallest
long. Documents of equal doc_id never remove from each other; repeated rows lose the same
bytes. Texts shorter than ``width`` stay whole. Longer texts than ``PIECE_BYTES`` are handled in
overlapping pieces. Columns named like those added are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmine.llm.suffix_arrays import WORD, common_prefixes, suffix_array, words_at
from trailmine.llm.text import flat_bytes, mix, widened
from trailmine.storage import materialise

WIDTH, GRAM = 50, 16
SHARD_BYTES = BUCKET_BYTES = 4 << 20
PIECE_BYTES = 4 << 20
FAN_IN = 4096  # shards merged at once
LEAST = -(1 << 63)
SPANS = "removed array<struct<start:long, stop:long>>, n_bytes long, kept binary"
_KEYS = "shard long, bucket long, keys binary"
_SENT = "shard long, bucket long, texts binary, places binary"


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as compressed bytes."""
    raw = b"".join(c.tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _packed_spans(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    return _packed(_steps(owner.astype("<i4")), start.astype("<u4"), (stop - start).astype("<u4"))


def _unpacked_spans(packed: bytes) -> tuple[np.ndarray, ...]:
    owner, start, size = _unpacked(packed, "<i4", "<u4", "<u4")
    return np.cumsum(owner), start.astype(np.int64), start.astype(np.int64) + size


def stretches(inside: np.ndarray, new: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true values; a run also ends where ``new`` is true."""
    change = inside[1:] != inside[:-1]
    if new is not None:
        change |= inside[1:] & new[1:]
    borders = np.flatnonzero(np.concatenate([[True], change, [True]])) if len(inside) else np.zeros(1, np.int64)
    begins, ends = borders[:-1], borders[1:]
    kept = inside[begins] if len(begins) else np.zeros(0, bool)
    return begins[kept], ends[kept]


def window_keys(words: np.ndarray, n: int, width: int) -> np.ndarray:
    """The key of the window at each of the first ``n`` places; ``words`` go on behind them."""
    low = mix(words[: n + width] * np.uint64(0x9E3779B97F4A7C15) + words[WORD : n + width + WORD])
    span, size = width - GRAM + 1, 1
    while size < span:
        step = min(size, span - size)
        low = np.minimum(low[:-step], low[step:])
        size += step
    return mix(low[:n] + np.uint64(1))


@dataclass
class _Piece:
    """Documents, or a part of one, of a shard."""

    number: int
    owner: np.ndarray  # place in the shard of each document
    base: np.ndarray  # where the bytes here begin in their document
    data: np.ndarray
    first: np.ndarray  # where each document begins in data, and the end

    def windows(self, width: int) -> np.ndarray:
        """Which places of data begin a window."""
        whole = np.zeros(len(self.data) + 1, np.int64)
        sizes = np.diff(self.first)
        fit = sizes >= width
        np.add.at(whole, self.first[:-1][fit], 1)
        np.add.at(whole, (self.first[1:] - width + 1)[fit], -1)
        return np.cumsum(whole[:-1]) > 0


def _pieces(shard: pa.Table, width: int) -> Iterator[_Piece]:
    """The documents of a shard, which are in order, in pieces of bounded size."""
    data, offsets = flat_bytes(shard.column("text").combine_chunks())
    sizes = np.diff(offsets)
    begin = number = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, "right")) - 1)
        if end > begin + 1 or sizes[begin] <= PIECE_BYTES:
            yield _Piece(number, np.arange(begin, end), np.zeros(end - begin, np.int64),
                         data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
            number += 1
        else:
            for base in range(0, int(sizes[begin]), PIECE_BYTES):
                own = data[offsets[begin] + base : min(offsets[begin] + base + PIECE_BYTES + width - 1, offsets[end])]
                yield _Piece(number, np.array([begin]), np.array([base]), own, np.array([0, len(own)]))
                number += 1
        begin = end


def _ordered(shard: pa.Table) -> pa.Table:
    """The documents by doc_id and text: in each step the same place is the same document."""
    return shard.sort_by([("__doc", "ascending"), ("__hash", "ascending")])


def _shared_inside(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The keys that windows of several doc_ids have, in ascending order."""
    order = np.argsort(keys)
    own = keys[order]
    begins = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    of = docs[order]
    return own[begins][np.minimum.reduceat(of, begins) < np.maximum.reduceat(of, begins)] if len(own) else own


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among ``known``, which ascend."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _changes(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[_changes(values)]


def _split_key(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and name inside the bucket. Different keys that meet cost time only."""
    return (keys % np.uint64(buckets)).astype(np.int64), (keys >> np.uint64(32)).astype("<u4")


def _joined_key(bucket: np.ndarray, name: np.ndarray) -> np.ndarray:
    return bucket.astype(np.uint64) << np.uint64(32) | name.astype(np.uint64)


def _tell_keys(width: int, buckets: int) -> Callable:
    """Step 1, for a shard: the keys it has, by bucket."""

    def tell(shard: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        number = shard.column("__shard")[0].as_py()
        for piece in _pieces(_ordered(shard), width):
            keys = window_keys(words_at(piece.data, width + WORD), len(piece.data), width)[piece.windows(width)]
            bucket, name = _split_key(keys[_changes(keys)], buckets)
            joined = _distinct(_joined_key(bucket, name))
            bucket = joined >> np.uint64(32)
            begins = np.flatnonzero(_changes(bucket))
            for a, b in zip(begins, np.append(begins[1:], len(bucket))):
                out[0].append(number)
                out[1].append(int(bucket[a]))
                out[2].append(_packed(_steps((joined[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4"))))
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["shard", "bucket", "keys"])

    return tell


def _share_keys(told: pa.Table) -> pa.Table:
    """Step 1, for a bucket: the keys that several pieces have, for each shard that has some."""
    keys = [np.cumsum(_unpacked(k, "<u4")[0], dtype="<u4") for k in told.column("keys").to_pylist()]
    every = np.sort(np.concatenate(keys))
    shared = _distinct(every[1:][every[1:] == every[:-1]])
    own = [k[_member(k, shared)] for k in keys]
    some = [i for i, k in enumerate(own) if len(k)]
    packed = pa.array([_packed(_steps(own[i])) for i in some], pa.binary())
    return told.select(["shard", "bucket"]).take(pa.array(some, pa.int64())).append_column("keys", packed)


def _sent(out: list[list], shard: int, bucket: int, texts: bytes, places: bytes) -> None:
    for column, value in zip(out, (shard, bucket, texts, places)):
        column.append(value)


def _sent_table(out: list[list]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], ["shard", "bucket", "texts", "places"])


def _sort_shard(width: int, buckets: int) -> Callable:
    """Step 2: what goes inside the shard (bucket -1), and what other buckets must see."""

    def sort(shard: pa.Table, told: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if not shard.num_rows:
            return _sent_table(out)
        number = shard.column("__shard")[0].as_py()
        shard = _ordered(shard)
        doc_ids = np.asarray(shard.column("__doc").combine_chunks())
        common = [_joined_key(np.full(1, b), np.cumsum(_unpacked(k, "<u4")[0], dtype="<u4"))
                  for b, k in zip(told.column("bucket").to_pylist(), told.column("keys").to_pylist())]
        common = _distinct(np.concatenate(common)) if common else np.zeros(0, np.uint64)
        for piece in _pieces(shard, width):
            _sort_piece(piece, doc_ids, number, common, width, buckets, out)
        return _sent_table(out)

    return sort


def _sort_piece(piece: _Piece, doc_ids: np.ndarray, number: int, common: np.ndarray, width: int, buckets: int, out: list[list]) -> None:
    n = len(piece.data)
    keys = window_keys(words_at(piece.data, width + WORD), n, width)
    window = piece.windows(width)
    owner = np.repeat(np.arange(len(piece.owner)), np.diff(piece.first))
    border = _changes(owner)
    # Neighbouring windows of one key and document are looked up once.
    runs = np.flatnonzero(window & (_changes(keys) | border))
    if not len(runs):
        return
    length = np.diff(np.append(runs, n))
    bucket, name = _split_key(keys[runs], buckets)

    def everywhere(of_runs: np.ndarray) -> np.ndarray:
        return np.append(np.zeros(runs[0], bool), np.repeat(of_runs, length)) & window

    inside = everywhere(_member(keys[runs], _shared_inside(keys[runs], doc_ids[piece.owner[owner[runs]]])))
    abroad = everywhere(_member(_joined_key(bucket, name), common))
    gone = _gone_inside(piece.data, doc_ids[piece.owner], owner, *stretches(inside, border), width)

    def place_of(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of = owner[begins]
        return piece.owner[of], begins - piece.first[of] + piece.base[of]

    a, b = stretches(gone, border)
    if len(a):
        of, start = place_of(a)
        _sent(out, number, -1, b"", _packed_spans(of, start, start + b - a + width - 1))
    a, b = stretches(abroad & ~gone, border | _changes(keys))
    bucket = _split_key(keys[a], buckets)[0]
    sort = np.argsort(bucket, kind="stable")
    a, b, bucket = a[sort], b[sort], bucket[sort]
    raw = piece.data.tobytes()
    borders = np.append(np.flatnonzero(_changes(bucket)), len(bucket))
    for low, high in zip(borders, borders[1:]):
        texts = b"".join([raw[i : j + width - 1] for i, j in zip(a[low:high].tolist(), b[low:high].tolist())])
        of, start = place_of(a[low:high])
        _sent(out, number, int(bucket[low]), _packed(np.frombuffer(texts, np.uint8)),
              _pack_contexts(doc_ids[of], of, start, (b - a)[low:high]))


def _gone_inside(data: np.ndarray, doc_ids: np.ndarray, owner: np.ndarray, begins: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Of the windows that begin in the given stretches, those that a smaller doc_id has too."""
    out = np.zeros(len(data), bool)
    if not len(begins):
        return out
    # The stretches end to end, each with the rest of its last window.
    sizes = ends - begins + width - 1
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(begins - first, sizes)
    window = np.repeat(ends, sizes) > at
    words = words_at(data[at], width + WORD)
    order = suffix_array(words[: len(at)])
    new = np.append(True, common_prefixes(words, order, width)[1:] < width)
    doc = np.where(window, doc_ids[owner[at]], np.iinfo(np.int64).max)[order]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))
    gone = order[doc > least[np.cumsum(new) - 1]]
    out[at[gone[window[gone]]]] = True
    return out


def _pack_contexts(doc_ids: np.ndarray, owner: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
    return _packed(_steps(doc_ids.astype("<i8")), _steps(owner.astype("<i4")), start.astype("<u4"), count.astype("<u4"))


def _same_bytes(words: np.ndarray, x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    same = np.ones(len(x), bool)
    for k in _word_places(width):
        same &= words[x + k] == words[y + k]
    return same


def _names(words: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """A hash of the window at each place."""
    out = np.zeros(len(windows), np.uint64)
    for k in _word_places(width):
        out ^= words[windows + k]
        out *= np.uint64(0xA24BAED4963EE407)
        out ^= out >> np.uint64(32)
    return mix(out)


def _word_places(width: int) -> list[int]:
    return [*range(0, width - WORD, WORD), width - WORD]


def merged_least(words: np.ndarray, windows: list[np.ndarray], docs: list[np.ndarray], width: int) -> list[np.ndarray]:
    """For each window of each shard, the smallest doc_id that has it in any shard.

    ``windows`` are places in ``words``. The names of each shard are sorted and merged; each
    shard finds its windows in the merged list by binary search.
    """
    names = [_names(words, w, width) for w in windows]
    orders = [np.argsort(x) for x in names]
    lists = [x[o] for x, o in zip(names, orders)]
    merged = np.sort(np.concatenate(lists), kind="stable")  # merges the lists
    merged = merged[_changes(merged)]
    least = np.full(len(merged), np.iinfo(np.int64).max)
    member = np.zeros(len(merged), np.int64)
    found = [np.empty_like(o) for o in orders]
    for own, order, x in zip(found, orders, lists):
        own[order] = np.searchsorted(merged, x)
    for w, d, f in zip(windows, docs, found):
        np.minimum.at(least, f, d)
        member[f] = w
    out = [least[f] for f in found]
    if not all(_same_bytes(words, w, member[f], width).all() for w, f in zip(windows, found)):
        # Different windows share a name: tell them apart by their bytes.
        known: dict[tuple, int] = {}
        spelt = [list(zip(*(words[w + k].tolist() for k in _word_places(width)))) for w in windows]
        for own, d in zip(spelt, docs):
            for window, doc in zip(own, d.tolist()):
                known[window] = min(known.get(window, doc), doc)
        out = [np.array([known[x] for x in own], np.int64) for own in spelt]
    return out


def _merge_shards(width: int, last: bool) -> Callable:
    """Step 3, for a bucket: what goes out of each shard, and before the last merge what stays."""

    def merge(sent: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        shards, buckets = sent.column("shard").to_pylist(), sent.column("bucket").to_pylist()
        if buckets[0] < 0:  # known already
            return sent.select(["shard", "bucket", "texts", "places"])
        texts = [_unpacked(t, "u1")[0] for t in sent.column("texts").to_pylist()]
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        words = words_at(np.concatenate(texts), width + WORD)
        windows, docs, contexts = [], [], []
        for t, packed in zip(begin, sent.column("places").to_pylist()):
            doc_ids, owner, start, count = _unpacked(packed, "<i8", "<i4", "<u4", "<u4")
            doc_ids, owner, count = np.cumsum(doc_ids), np.cumsum(owner), count.astype(np.int64)
            first = np.cumsum(count) - count
            windows.append(np.arange(int(count.sum())) + np.repeat(t + np.arange(len(count)) * (width - 1), count))
            docs.append(np.repeat(doc_ids, count))
            contexts.append((doc_ids, owner, start.astype(np.int64), count, first))
        for k, least in enumerate(merged_least(words, windows, docs, width)):
            doc_ids, owner, start, count, first = contexts[k]
            gone = docs[k] > least
            of = np.repeat(np.arange(len(count)), count)
            a, b = stretches(gone, _changes(of))
            if len(a):
                low = start[of[a]] + a - first[of[a]]
                _sent(out, shards[k], -1, b"", _packed_spans(owner[of[a]], low, low + b - a + width - 1))
            if not last:
                stays = np.flatnonzero(~np.logical_and.reduceat(gone, first))
                if len(stays):
                    raw, place = texts[k].tobytes(), first + np.arange(len(count)) * (width - 1)
                    kept = b"".join(raw[place[c] : place[c] + count[c] + width - 1] for c in stays)
                    _sent(out, shards[k], buckets[k], _packed(np.frombuffer(kept, np.uint8)),
                          _pack_contexts(doc_ids[stays], owner[stays], start[stays], count[stays]))
        return _sent_table(out)

    return merge


def _united(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one, in order."""
    order = np.argsort(start)
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > stop[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return start[new], stop[last]


def _cut_shard(names: list[str]) -> Callable:
    """Step 4: the documents of a shard with what goes and what stays."""

    def cut(shard: pa.Table, sent: pa.Table) -> pa.Table:
        shard = _ordered(shard)
        spans: list[tuple[np.ndarray, ...]] = [_unpacked_spans(p) for p in sent.column("places").to_pylist()]
        owner, start, stop = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 3
        order = np.argsort(owner, kind="stable")
        owner, start, stop = owner[order], start[order], stop[order]
        upto = np.searchsorted(owner, np.arange(shard.num_rows + 1))
        removed, sizes, kept = [], [], []
        for k, text in enumerate(shard.column("text").cast(pa.large_string()).to_pylist()):
            raw = (text or "").encode()
            sizes.append(len(raw))
            a, b = upto[k], upto[k + 1]
            if a == b:
                removed.append([])
                kept.append(raw)
                continue
            low, high = (x.tolist() for x in _united(start[a:b], stop[a:b]))
            removed.append([{"start": i, "stop": j} for i, j in zip(low, high)])
            kept.append(b"".join(raw[i:j] for i, j in zip([0, *high], [*low, len(raw)])))
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        out = shard.select(names)
        for name, column in (("removed", pa.array(removed, span)), ("n_bytes", pa.array(sizes, pa.int64())), ("kept", pa.array(kept, pa.binary()))):
            out = out.append_column(name, column)
        return out

    return cut


def _part(groups: int) -> Column:
    """Shards that are merged together; rows that are done go on by themselves."""
    return F.when(F.col("bucket") < 0, F.col("shard")).otherwise(F.pmod(F.xxhash64("shard"), F.lit(groups))).alias("part")


def remove_repeated_bytes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with what is repeated: ``removed``, ``n_bytes`` and ``kept``.

    Needs ``doc_id`` and ``text``; all columns stay. ``removed`` has the maximal spans of bytes
    that go, in order, ``n_bytes`` is the size of the text and ``kept`` its other bytes, which
    need not be whole characters. ``width`` is 24 at least.
    """
    if width < GRAM + WORD:
        raise ValueError(f"width must be {GRAM + WORD} at least")
    spark = docs.sparkSession
    docs = docs.drop("removed", "n_bytes", "kept")
    names = docs.columns
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = max(1, -(-total // SHARD_BYTES)), max(1, -(-total // BUCKET_BYTES))
    # Shuffled once: all steps read the same exchange.
    tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = F.xxhash64("text")
    own = docs.select(
        "*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("__doc"), hashed.alias("__hash"),
        F.pmod(F.xxhash64(F.col("doc_id"), hashed), F.lit(shards)).alias("__shard")).repartition(tasks, "__shard")
    told = own.groupBy("__shard").applyInArrow(_tell_keys(width, buckets), _KEYS)
    shared = told.groupBy("bucket").applyInArrow(_share_keys, _KEYS)
    sent = own.groupBy("__shard").cogroup(shared.groupBy("shard")).applyInArrow(_sort_shard(width, buckets), _SENT)
    groups = shards
    while True:
        groups = -(-groups // FAN_IN)
        sent = sent.groupBy("bucket", _part(groups)).applyInArrow(_merge_shards(width, groups == 1), _SENT)
        if groups == 1:
            break
        sent = materialise(sent, "merged-shards")
    return own.groupBy("__shard").cogroup(sent.groupBy("shard")).applyInArrow(_cut_shard(names), widened(docs, SPANS))
