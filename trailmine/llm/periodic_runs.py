"""Periodic runs of words, by a run-length grammar of each batch of texts.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are the same), at
least ``max(6, 4 * q)`` long, that no neighbouring word extends. Every such run holds a place
``g`` of the grid ``0, 2q, 4q, ...`` together with ``g + q``. So the grids of all ``q``, about
``n / 2 * ln(n / 4)`` places for ``n`` words, name all candidates, and how far the words at
``g`` and ``g + q`` agree to the right and to the left gives the run exactly.

These extensions are answered by a grammar, without suffix arrays. Words become numbers, and
two steps alternate: equal neighbours become one symbol that knows its length (blocks), then
symbols are dealt to two sides by a hash, and a symbol of the first side with one of the
second behind it becomes a symbol of its own (pairs). Both steps do the same with the same
words wherever they stand, so equal stretches get equal symbols up to their borders. Symbols
that occur once in their text match nothing and are folded with their neighbours of that kind.
A comparison climbs while whole symbols agree, takes equal blocks in one step, and goes down
where they differ: some log n steps, done for all candidates of a batch at once.

Each text is handled by itself, in batches of bounded size; no shuffle is needed. A very long
text comes alone, its candidates in portions. Null and empty texts have no words and no runs,
and collapse to the empty text. Repeated rows are handled each. Columns named like those added
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailmine.llm import text as texts
from trailmine.llm.text import BLANK_SEPARATED, Words, slices, widened

LEAST_WORDS, LEAST_PERIODS = 6, 4  # of a run
SLICE_BYTES = 1 << 20  # of text handled at once; a longer text comes alone
PORTION = 1 << 20  # candidates handled at once
ADDED = "n_words long, runs array<struct<start:long, length:long, period:long>>, collapsed string"


def _stretches(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes of stretches of ``data``, one after the other, in portions."""
    total = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + PORTION, "right")))
        own = sizes[begin:end]
        place = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        yield data[np.repeat(starts[begin:end], own) + place]
        begin = end


def word_numbers(words: Words, owner: np.ndarray) -> np.ndarray:
    """A number for each word; equal words of one text, and only these, have the same."""
    _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    sizes = words.ends - words.starts
    twin = first[number]
    same = bool((sizes == sizes[twin]).all()) and all(
        np.array_equal(x, y) for x, y in zip(*(_stretches(words.data, words.starts[k], sizes) for k in (slice(None), twin))))
    if not same:  # two words share a hash: number them by their bytes
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(words.data[a:b].tobytes(), len(known)) for a, b in zip(words.starts, words.ends)])
    return np.unique(owner * (int(number.max(initial=0)) + 1) + number, return_inverse=True)[1]


class Grammar:
    """The levels of a sequence, from its symbols up, laid end to end.

    ``symbol`` is comparable on one level only. ``first`` and ``last`` are the children on
    the level below (-1 on the lowest), ``parent`` the symbol above (-1 on the highest),
    ``weight`` the length on the lowest level. ``ahead`` and ``behind`` count the equal
    symbols from one on to the right and to the left, itself included.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        n = len(sequence)
        self._levels: list[list[np.ndarray]] = []
        self._at = 0
        symbols = np.unique(sequence, return_inverse=True)[1]
        nothing = np.full(n, -1)
        self._add(symbols, nothing, nothing, np.ones(n, np.int64))
        seed = 0
        while True:
            symbols = self._levels[-1][0]
            counts = np.bincount(symbols)
            if counts.max(initial=0) < 2:
                break
            once = counts[symbols] == 1
            letter = np.where(once, -1, symbols)
            begins = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
            if len(begins) < len(symbols):
                self._blocks(symbols, once, begins)
                symbols = self._levels[-1][0]
                if np.bincount(symbols).max() < 2:
                    break
            seed = self._pairs(symbols, seed)
        columns = list(zip(*self._levels))
        self.symbol, self.first, self.last, self.weight, self.parent, self.ahead, self.behind = (
            np.concatenate([c.astype(np.int32, copy=False) for c in column]) for column in columns)
        del self._levels

    def _add(self, symbols: np.ndarray, first: np.ndarray, last: np.ndarray, weights: np.ndarray) -> None:
        ones = np.ones(len(symbols), np.int32)
        self._levels.append([symbols, first, last, weights, np.full(len(symbols), -1), ones, ones])

    def _cover(self, begins: np.ndarray, names: np.ndarray) -> None:
        """The next level: symbols of the last one from ``begins`` on become one."""
        below = self._levels[-1]
        n = len(below[0])
        ends = np.append(begins[1:], n)
        above = self._at + n
        below[4] = above + np.repeat(np.arange(len(begins)), ends - begins)
        weights = np.add.reduceat(below[3], begins)
        first, last = self._at + begins, self._at + ends - 1
        self._at = above
        self._add(np.unique(names, return_inverse=True)[1], first, last, weights)

    def _blocks(self, symbols: np.ndarray, once: np.ndarray, begins: np.ndarray) -> None:
        lengths = np.diff(np.append(begins, len(symbols)))
        place = np.arange(len(symbols)) - np.repeat(begins, lengths)
        below = self._levels[-1]
        below[5] = np.where(once, 1, np.repeat(lengths, lengths) - place)
        below[6] = np.where(once, 1, place + 1)
        most = int(lengths.max()) + 1
        folded = once[begins]
        names = symbols[begins] * most + lengths
        names[folded] = -1 - np.arange(int(folded.sum()))
        self._cover(begins, names)

    def _pairs(self, symbols: np.ndarray, seed: int) -> int:
        kinds = int(symbols.max()) + 1
        best = None
        for seed in range(seed, seed + 4):
            side = (texts.mix(np.arange(kinds, dtype=np.uint64) + np.uint64(seed << 32)) & np.uint64(1)).astype(bool)[symbols]
            heads = ~side[:-1] & side[1:]
            if best is None or heads.sum() > best.sum():
                best = heads
        if best.any():
            inside = np.append(False, best)
            begins = np.flatnonzero(~inside)
            paired = np.append(best, False)[begins]
            second = np.where(paired, symbols[np.minimum(begins + 1, len(symbols) - 1)], -1)
            self._cover(begins, symbols[begins] * (kinds + 1) + second + 1)
        return seed + 1

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols of the lowest level agree from ``a`` and ``b`` on, to the right
        (``step`` 1) or left (-1). A symbol that occurs once must follow either way."""
        edge, run = (self.first, self.ahead) if step == 1 else (self.last, self.behind)
        found = np.zeros(len(a), np.int64)
        open_, climbing = np.arange(len(a)), np.ones(len(a), bool)
        while len(open_):
            same = self.symbol[a] == self.symbol[b]
            over_a, over_b = self.parent[a], self.parent[b]
            up = same & climbing & (over_a >= 0)
            up &= (edge[over_a] == a) & (edge[over_b] == b) & (self.symbol[over_a] == self.symbol[over_b])
            on = same & ~up
            far = np.where(on, np.minimum(run[a], run[b]), 0)
            found[open_] += far * self.weight[a].astype(np.int64)
            below_a, below_b = edge[a], edge[b]
            a = np.where(up, over_a, np.where(same, a + step * far, below_a))
            b = np.where(up, over_b, np.where(same, b + step * far, below_b))
            climbing &= same
            left = a >= 0
            if not left.all():
                a, b, open_, climbing = a[left], b[left], open_[left], climbing[left]
        return found


def _candidates(numbers: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places and periods at which the word one period ahead is the same."""
    counts = np.diff(first)
    periods = counts // LEAST_PERIODS
    text = np.repeat(np.arange(len(counts)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    n = counts[text]
    places = (n - 1 - q) // (2 * q) + 1
    total = np.cumsum(places)
    begin = 0
    while begin < len(q):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + PORTION, "right")))
        own = places[begin:end]
        k = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        period = np.repeat(q[begin:end], own)
        g = np.repeat(first[text[begin:end]], own) + 2 * period * k
        good = numbers[g] == numbers[g + period]
        yield g[good], period[good]
        begin = end


def runs_of(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (over all texts), length and period of all runs, in order of start and period.

    ``numbers`` tells words apart; ``first[i]:first[i + 1]`` are those of text ``i``.
    """
    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    grammar = None
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for g, q in _candidates(numbers, first):
        if not len(g):
            continue
        if grammar is None:
            # A symbol that occurs once stands before, between and behind the texts.
            border = int(numbers.max()) + 1 + np.arange(len(first))
            sequence = np.insert(numbers, first, border)
            grammar = Grammar(sequence)
        a = g + text[g] + 1
        ahead = grammar.extend(a, a + q, 1)
        back = grammar.extend(a - 1, a - 1 + q, -1)
        length = back + q + ahead
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(((g - back)[good], length[good], q[good]))
    start, length, period = (np.concatenate(x) for x in zip(*found))
    # One stretch can be found by multiples of its period.
    order = np.lexsort([period, length, start])
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])) if len(start) else np.zeros(0, bool)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def _collapsed(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, with one space between them."""
    sizes = words.ends - words.starts + 1
    wanted = np.flatnonzero(kept)
    ends = np.cumsum(sizes[wanted])
    # The byte behind a word belongs to no word, or is the first of the next text.
    source = np.append(words.data, np.uint8(0x20))
    out = np.concatenate([np.zeros(0, np.uint8), *_stretches(source, words.starts[wanted], sizes[wanted])])
    out[ends - 1] = 0x20
    upto = np.append(0, ends)[np.searchsorted(wanted, words.first)]
    buffer = out.tobytes()
    return pa.array([buffer[a : max(a, b - 1)].decode() for a, b in zip(upto, upto[1:])], pa.string())


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        words = texts.words_of(batch.column("text"), BLANK_SEPARATED, lower=False)
        first = words.first
        start, length, period = runs_of(word_numbers(words, words.owner), first) if len(words.hashes) else (np.zeros(0, np.int64),) * 3
        change = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        kept = np.cumsum(change[:-1]) == 0
        owner = np.searchsorted(first, start, "right") - 1
        offsets = np.searchsorted(start, first).astype(np.int32)
        values = pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start - first[owner], length, period)], ["start", "length", "period"])
        for name, column in (("n_words", pa.array(words.counts, pa.int64())), ("runs", pa.ListArray.from_arrays(pa.array(offsets), values)),
                             ("collapsed", _collapsed(words, kept))):
            batch = batch.append_column(name, column)
        yield batch


def find_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Needs ``text``; all columns stay. ``runs`` are ``(start, length, period)`` in words, by
    start, then period. ``collapsed`` keeps the first period of each run: a word goes if any
    run has it behind its first ``period`` words; the others are joined by one space.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    return docs.mapInArrow(_find, widened(docs, ADDED))
