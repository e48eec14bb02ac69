"""Words of UTF-8 texts as arrays: one pass over the bytes of an Arrow column.

Words are runs of bytes of a class. Both classes used here treat every byte from 128
on as part of a word, so that cutting bytes equals cutting characters. A word is known
by a 64-bit hash of its bytes with A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

BLOCK_BYTES = 1 << 20  # bytes handled at once; only a longer word makes a block longer

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWERED_VALUES = _BYTE_VALUES[_LOWER]

#: Words between blanks: everything but space and TAB to CR.
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

#: Digits, letters and all bytes of characters beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def unmix(values: np.ndarray) -> np.ndarray:
    """The values that :func:`mix` was given."""
    back = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    values = (values ^ (values >> np.uint64(32))) * back
    values = (values ^ (values >> np.uint64(32))) * back
    return values ^ (values >> np.uint64(32))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes."""
    state = mix(parts[0] + np.uint64(len(parts)))
    for part in parts[1:]:
        state = mix(state * np.uint64(0xA24BAED4963EE407) + part)
    return state


class _Powers:
    """Powers of the base and of its inverse, as many as the longest block needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if n >= len(self.up):
            steps = np.full(n + 1, _BASE)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _BASE_INVERSE
            self.down = np.multiply.accumulate(steps)


_POWERS = _Powers()


@dataclass(frozen=True)
class Words:
    """Words of some texts. ``first[i]:first[i + 1]`` are the words of text ``i``."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def normal(self, i: int) -> bytes:
        """The bytes of one word, in lower case."""
        return self.data[self.starts[i] : self.ends[i]].tobytes().lower()


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> list[int]:
    """Block borders that lie inside no word."""
    cuts, at, end = [0], 0, len(data)
    while end - at > BLOCK_BYTES:
        border = at + BLOCK_BYTES
        k = np.searchsorted(offsets, border, "right") - 1
        if offsets[k] > at:
            at = int(offsets[k])
        else:  # inside one long text: back to its last separator, else on to the next
            back = np.flatnonzero(~inside[data[at:border]])
            if len(back):
                at += int(back[-1]) + 1
            else:
                stop, at = int(offsets[k + 1]), border
                while at < stop and inside[data[at]]:
                    ahead = np.flatnonzero(~inside[data[at : min(at + BLOCK_BYTES, stop)]])
                    at = at + int(ahead[0]) if len(ahead) else min(at + BLOCK_BYTES, stop)
        cuts.append(at)
    return [*cuts, end] if cuts[-1] < end else cuts


def words_of(texts: pa.Array, inside: np.ndarray = BLANK_SEPARATED, lower: bool = True) -> Words:
    """Words of a string column. ``inside`` tells for each byte whether words hold it.

    Without ``lower`` the hashes tell upper from lower case.
    """
    data, offsets = flat_bytes(texts)
    byte_values = _LOWERED_VALUES if lower else _BYTE_VALUES
    begins, stops, hashes = [], [], []
    cuts = _cuts(data, offsets, inside)
    for low, high in zip(cuts, cuts[1:]):
        block = data[low:high]
        member = inside[block]
        border = np.zeros(len(block) + 1, bool)  # texts begin here
        own = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")]
        border[own - low] = True
        border[0] = border[-1] = True
        begin = member.copy()
        begin[1:] &= ~member[:-1] | border[1:-1]
        stop = member.copy()
        stop[:-1] &= ~member[1:] | border[1:-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        _POWERS.need(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(byte_values[block] * _POWERS.up[: len(block)], out=sums[1:])
        begins.append(s + low)
        stops.append(e + low)
        hashes.append(mix((sums[e] - sums[s]) * _POWERS.down[s]))
    starts = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return Words(
        data,
        starts,
        np.concatenate(stops) if stops else np.zeros(0, np.int64),
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        np.searchsorted(starts, offsets) if len(starts) else np.zeros(len(offsets), np.int64),
    )


def hash_word(word: str) -> int:
    """The hash that :func:`words_of` gives a text of this one word."""
    return int(words_of(pa.array([word])).hashes[0])


def shingles_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``width`` consecutive words, text by text, each sorted.

    A text of fewer words, but not none, has its whole sequence as one. Returns the
    hashes and the place where each text's begin.
    """
    n = len(words.hashes)
    sets = []
    whole = combine([words.hashes[k : n - width + 1 + k] for k in range(width)]) if n >= width else None
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            sets.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            sets.append(combine([words.hashes[i : i + 1] for i in range(a, b)]))
        else:
            sets.append(np.zeros(0, np.uint64))
    first = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=first[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), first


def widened(df: DataFrame, columns: str) -> StructType:
    """The schema of ``df`` with more columns, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.nan_to_num(np.array(
            pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)))
        begin = 0
        while begin < batch.num_rows:
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + max_bytes, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
