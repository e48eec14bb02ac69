"""Passages of benchmark items in documents, by Wu-Manber search over words.

Patterns are windows of ``width`` consecutive words of an item (an item of fewer words is
one window), in lower case. Patterns of one length are searched together: a table of
shifts tells for each block of two words how far the window may move without missing a
pattern. Where the shift is zero, the hash of the pattern's last block selects its bucket
of patterns, whose words are then compared, first as hashes, then as bytes. The documents
are searched in a single pass; many places of a document move in step as arrays.

Patterns are handled in blocks of bounded size. Only one block is on the driver at a time;
each is sent to the executors. All blocks are searched in one Python stage: a task holds the
tables of one block, and searches each slice of its documents block by block, so that no item
is left out however large the benchmark is.

Null and empty documents have no words. Null and empty items have no windows. Items are
known by their item_id as a string; a null one counts as an empty string.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.llm.sending import send
from trailmine.llm.text import ALPHANUMERIC, Words, slices, widened, words_of

WIDTH = 10
BLOCK_BYTES = 4 << 20  # item text on the driver, and sent to executors, at once
SLICE_BYTES = 4 << 20  # document text searched at once
SLICE_BYTES_OF_BLOCKS = 16 << 20  # where each slice has the tables of all blocks loaded anew
_SHIFT_BITS = 20
_SEGMENT = 512  # window ends that one cursor passes
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _block_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * _FIRST + second * _SECOND) ^ (second >> np.uint64(29))


@dataclass
class Patterns:
    """Patterns of one length with their search tables."""

    words: np.ndarray  # one row of word hashes a pattern, ordered by suffix
    items: list[list[str]]
    shift: np.ndarray
    suffixes: np.ndarray  # code of the last block, sorted

    @classmethod
    def of(cls, windows: dict[tuple[int, ...], set[str]]) -> Patterns:
        rows = list(windows)
        words = np.array(rows, np.uint64)
        length = words.shape[1]
        block = min(2, length)
        shift = np.full(1 << _SHIFT_BITS, length - block + 1, np.uint8 if length < 256 else np.int64)
        for end in range(block - 1, length):
            codes = _block_codes(words[:, end - block + 1], words[:, end])
            np.minimum.at(shift, codes >> np.uint64(64 - _SHIFT_BITS), length - 1 - end)
        last = _block_codes(words[:, length - block], words[:, length - 1])
        order = np.argsort(last, kind="stable")
        return cls(words[order], [sorted(windows[rows[i]]) for i in order], shift, last[order])

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Last word and pattern of each occurrence, before bytes are compared."""
        length = self.words.shape[1]
        back = min(2, length) - 1
        starts, stops = words.first[:-1] + length - 1, words.first[1:]
        parts = np.maximum(0, -(-(stops - starts) // _SEGMENT))
        text = np.repeat(np.arange(len(parts)), parts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = starts[text] + part * _SEGMENT
        stop = np.minimum(at + _SEGMENT, stops[text])
        hits = []
        while len(at):
            codes = _block_codes(words.hashes[at - back], words.hashes[at])
            move = self.shift[codes >> np.uint64(64 - _SHIFT_BITS)].astype(np.int64)
            hits.append(at[move == 0])
            at = at + np.maximum(move, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        codes = _block_codes(words.hashes[ends - back], words.hashes[ends])
        low, high = np.searchsorted(self.suffixes, codes), np.searchsorted(self.suffixes, codes, "right")
        ends, pattern = np.repeat(ends, high - low), _ranges(low, high)
        for k in range(length):
            same = words.hashes[ends - length + 1 + k] == self.words[pattern, k]
            ends, pattern = ends[same], pattern[same]
        return ends, pattern


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0] .. high[0] - 1, low[1] .. high[1] - 1 and so on."""
    counts = high - low
    return np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)


def build_patterns(items: list[tuple[str, str]], width: int) -> tuple[list[Patterns], dict[int, bytes]]:
    """Search tables of ``(item, text)``, and the bytes of every word."""
    by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
    spelled: dict[int, bytes] = {}
    words = words_of(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC)
    for i, (item, _) in enumerate(items):
        low, high = words.first[i], words.first[i + 1]
        own = tuple(words.hashes[low:high].tolist())
        spelled |= {own[k - low]: words.normal(k) for k in range(low, high)}
        length = min(width, len(own))
        for k in range(len(own) - length + 1 if length else 0):
            by_length.setdefault(length, {}).setdefault(own[k : k + length], set()).add(item)
    return [Patterns.of(windows) for windows in by_length.values()], spelled


class _Found:
    """What the patterns searched so far hit in the texts of one batch."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch = batch
        self.words = words_of(batch.column("text"), ALPHANUMERIC)
        self.change = np.zeros(len(self.words.hashes) + 1, np.int64)
        self.held: list[set[str]] = [set() for _ in range(batch.num_rows)]

    def search(self, group: Patterns, spelled: dict[int, bytes]) -> None:
        words, length = self.words, group.words.shape[1]
        ends, pattern = group.occurrences(words)
        if not len(ends):
            return
        near = np.unique(_ranges(ends - length + 1, ends + 1))
        alike = np.zeros(len(words.hashes), bool)
        alike[near] = [words.normal(k) == spelled[int(words.hashes[k])] for k in near]
        sums = np.append(0, np.cumsum(alike))
        same = sums[ends + 1] - sums[ends + 1 - length] == length
        ends, pattern = ends[same], pattern[same]
        np.add.at(self.change, ends - length + 1, 1)
        np.add.at(self.change, ends + 1, -1)
        text = np.searchsorted(words.first, ends, "right") - 1
        for row, k in zip(*np.unique(np.stack([text, pattern]), axis=1)):
            self.held[row].update(group.items[k])

    def result(self) -> pa.RecordBatch:
        words, batch = self.words, self.batch
        hit = np.cumsum(self.change[:-1]) > 0
        before = np.append(False, hit[:-1])
        opens = words.first[:-1][words.counts > 0]
        first_word = np.zeros(len(hit), bool)
        first_word[opens] = True
        begin = np.flatnonzero(hit & (~before | first_word))
        after, last_word = np.append(hit[1:], False), np.append(first_word[1:], True)
        end = np.flatnonzero(hit & (~after | last_word[: len(hit)])) + 1
        text = np.searchsorted(words.first, begin, "right") - 1
        offsets = np.searchsorted(text, np.arange(batch.num_rows + 1))
        spans = pa.StructArray.from_arrays(
            [pa.array(begin - words.first[text]), pa.array(end - 1 - words.first[text])], ["first", "last"])
        made = [
            pa.array(words.counts),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans),
            pa.array([sorted(x) for x in self.held], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "n_words", "hits", "items"])


def _search(tables):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = tables[0]() if len(tables) == 1 else None
        for batch in slices(batches, "text", SLICE_BYTES if only else SLICE_BYTES_OF_BLOCKS):
            found = _Found(batch)
            for table in tables:
                patterns, spelled = only or table()
                for group in patterns:
                    found.search(group, spelled)
            yield found.result()

    return search


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` and ``items``; columns of these names are replaced.

    ``hits`` are the ranges of document words, ``first`` to ``last`` from 0, that lie in an
    occurrence of a window; ``items`` the sorted item ids whose windows occur.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = 1 + total * 5 // 4 // BLOCK_BYTES
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    docs = docs.drop("n_words", "hits", "items")
    tables = []
    for block in range(blocks):
        own = [(r["item"], r["text"]) for r in items.filter(F.col("block") == block).select("item", "text").collect()]
        tables.append(send(spark, build_patterns(own, width), keep=False))
    made = "n_words long, hits array<struct<first: bigint, last: bigint>>, items array<string>"
    return docs.mapInArrow(_search(tables), widened(docs, made))
