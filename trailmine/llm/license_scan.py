"""Licence phrases and templates in documents, by a suffix automaton of their words.

One automaton holds all phrases and templates. A document is streamed through it, which
gives for every place the longest run of words that ends there and stands in a template
(matching statistics). A *phrase* occurs where its state is the current one or a suffix
of it, and the run is long enough; every occurrence counts. For *templates* the maximal
runs of ``min_run`` words or more are chained: runs of one template, in the order of both
texts and at most ``max_gap`` words apart, cover a part of it. Every chain that covers
``min_cover`` of a template gives its label. Chains of one template do not overlap; they are
chosen so that together they cover most words, by the fewest and then the tightest chains,
so each copy of a licence has its own.

Only word pairs that stand in a template can be part of a run of two or more, so the
automaton is stepped over stretches of such pairs, and over phrases of one word outside
them; this changes no result for ``min_run`` of two or more.

Null and empty texts have no words, no labels and score 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailmine.llm.sending import send
from trailmine.llm.text import ALPHANUMERIC, slices, widened, words_of

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Sentences of well-known licences by which they are granted.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}
MIN_RUN, MAX_GAP, MIN_COVER = 4, 20, 0.7

REPORT = {
    "n_words": "long",
    "phrases": "array<struct<label: string, first: bigint, last: bigint>>",
    "spans": "array<struct<label: string, first: bigint, last: bigint, cover: double>>",
}


@dataclass
class _State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # template and place of the last word
    phrases: list[int] = field(default_factory=list)  # phrases that are suffixes, by number


class LicenseAutomaton:
    """Generalised suffix automaton of phrases and templates."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.phrases = [(words_of(pa.array([p]), ALPHANUMERIC).hashes.tolist(), label) for p, label in phrases.items()]
        self.templates = [(words_of(pa.array([t]), ALPHANUMERIC).hashes.tolist(), label) for label, t in templates.items()]
        self.states = [_State(0)]
        pairs = set()
        whole = []
        for number, (words, _) in enumerate([*self.phrases, *self.templates]):
            last = 0
            for place, word in enumerate(words):
                last = self._add(last, word)
                self.states[last].ends.append((number, place))
            whole.append(last)
            pairs.update(zip(words, words[1:]))
        order = sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length)
        for s in order:  # longest first: ends pass to the suffixes
            state = self.states[s]
            state.ends = sorted(set(state.ends))
            self.states[state.link].ends.extend(state.ends)
        owner: dict[int, list[int]] = {}
        for number in range(len(self.phrases)):
            owner.setdefault(whole[number], []).append(number)
        for s in reversed(order):
            self.states[s].phrases = [*self.states[self.states[s].link].phrases, *owner.get(s, [])]
        pairs = sorted(pairs)
        single = np.array([words[0] for words, _ in self.phrases if len(words) == 1], np.uint64)
        self.vocabulary = np.unique(np.append(np.array([w for p in pairs for w in p], np.uint64), single))
        at = np.searchsorted(self.vocabulary, np.array(pairs, np.uint64).reshape(-1, 2))
        self.pairs = np.zeros((len(self.vocabulary), len(self.vocabulary)), bool)
        self.pairs[at[:, 0], at[:, 1]] = True
        self.single = np.isin(self.vocabulary, single)

    def _add(self, last: int, word: int) -> int:
        states = self.states
        if word in states[last].next:
            target = states[last].next[word]
            if states[target].length == states[last].length + 1:
                return target
            return self._split(last, word, target)
        states.append(_State(states[last].length + 1))
        new, at = len(states) - 1, last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at < 0:
            states[new].link = 0
        else:
            target = states[at].next[word]
            fits = states[target].length == states[at].length + 1
            states[new].link = target if fits else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        states = self.states
        states.append(_State(states[at].length + 1, states[target].link, dict(states[target].next)))
        twin = len(states) - 1
        states[target].link = twin
        while at >= 0 and states[at].next.get(word) == target:
            states[at].next[word] = twin
            at = states[at].link
        return twin

    def stretches(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of stretches of known pairs inside one text, then of phrases of one word outside them."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        pair = known[:-1] & known[1:]
        pair &= self.pairs[at[:-1], at[1:]]
        inner = first[1:-1]
        inner = inner[(inner > 0) & (inner < len(hashes))]
        pair[inner - 1] = False
        edge = np.diff(np.concatenate([[0], pair.view(np.int8), [0]]))
        alone = known & self.single[at]
        alone[:-1] &= ~pair
        alone[1:] &= ~pair
        alone = np.flatnonzero(alone)
        return np.append(np.flatnonzero(edge == 1), alone), np.append(np.flatnonzero(edge == -1), alone)

    def follow(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run ending at each word."""
        states, state, length = self.states, 0, 0
        for word in words:
            while state and word not in states[state].next:
                state = states[state].link
                length = states[state].length
            if word in states[state].next:
                state, length = states[state].next[word], length + 1
            yield state, length


def _chains(runs: list[tuple[int, int, int]], max_gap: int, size: int, min_cover: float) -> list[tuple[int, int, int]]:
    """Covered words, first and last word of chains that do not overlap and together cover most.

    ``runs`` are ``(first word, length, place in the template)`` in order. Of equal covers
    the fewest and then the tightest chains are taken.
    """
    begins = [first for first, _, _ in runs]
    longest = max(length for _, length, _ in runs)
    # From each run to the end: covered words, chains and words inside them (both negative), and the first chain taken.
    best: list[tuple[int, int, int]] = [(0, 0, 0)] * (len(runs) + 1)
    taken: list[tuple[int, int, int, int] | None] = [None] * (len(runs) + 1)
    for at in range(len(runs) - 1, -1, -1):
        best[at], taken[at] = best[at + 1], taken[at + 1]
        start, length, place = runs[at]
        if size - place < min_cover * size:
            continue  # no chain from here covers enough
        chains, begin, furthest = [(start + length - 1, place + length - 1, length)], 0, start + length - 1
        for k in range(at, len(runs)):
            first, length, place = runs[k]
            if first - furthest - 1 > max_gap:
                break
            if k == at:
                covered = length
            else:
                covered = 0
                while begin < len(chains) and chains[begin][0] < first - max_gap - longest:
                    begin += 1
                for last, last_place, so_far in chains[begin:]:
                    if last < first + length - 1 and first - last - 1 <= max_gap and last_place < place + length - 1:
                        covered = max(covered, so_far + min(length, place + length - 1 - last_place, first + length - 1 - last))
                if not covered:
                    continue
                chains.append((first + length - 1, place + length - 1, covered))
                furthest = max(furthest, first + length - 1)
            if covered >= min_cover * size:
                then = bisect_right(begins, first + length - 1)
                total = best[then][0] + covered, best[then][1] - 1, best[then][2] - (first + length - start)
                if total > best[at]:
                    best[at], taken[at] = total, (covered, start, first + length - 1, then)
    found, chain = [], taken[0]
    while chain:
        found.append(chain[:3])
        chain = taken[chain[3]]
    return found


def _scan(automaton, min_run: int, max_gap: int, min_cover: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: LicenseAutomaton = automaton()
        n_phrases = len(auto.phrases)
        for batch in slices(batches, "text"):
            words = words_of(batch.column("text"), ALPHANUMERIC)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            runs: list[dict[int, list]] = [{} for _ in range(batch.num_rows)]
            if len(words.hashes) and len(auto.vocabulary):
                begins, ends = auto.stretches(words.hashes, words.first)
                rows = np.searchsorted(words.first, begins, "right") - 1
                for begin, end, row in zip(begins.tolist(), ends.tolist(), rows.tolist()):
                    low = begin - int(words.first[row])
                    steps = list(auto.follow(words.hashes[begin : end + 1].tolist()))
                    for k, (state, length) in enumerate(steps):
                        for number in auto.states[state].phrases:
                            size = len(auto.phrases[number][0])
                            if size <= length:
                                found[row].append({"label": auto.phrases[number][1], "first": low + k - size + 1, "last": low + k})
                        maximal = k + 1 == len(steps) or steps[k + 1][1] != length + 1
                        if maximal and length >= min_run:
                            for number, place in auto.states[state].ends:
                                if number >= n_phrases:
                                    runs[row].setdefault(number, []).append((low + k - length + 1, length, place - length + 1))
            spans = []
            for own in runs:
                spans.append([])
                for number, parts in sorted(own.items()):
                    template, label = auto.templates[number - n_phrases]
                    for covered, first, last in _chains(sorted(parts), max_gap, len(template), min_cover):
                        spans[-1].append({"label": label, "first": first, "last": last, "cover": min(1.0, covered / len(template))})
            struct = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
            batch = batch.append_column("n_words", pa.array(words.counts))
            batch = batch.append_column("phrases", pa.array([sorted(f, key=lambda p: (p["first"], p["last"], p["label"])) for f in found], pa.list_(struct)))
            yield batch.append_column("spans", pa.array(spans, pa.list_(pa.struct([*struct, ("cover", pa.float64())]))))

    return scan


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    min_run: int = MIN_RUN,
    max_gap: int = MAX_GAP,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """``docs`` with ``n_words``, ``phrases`` and ``spans``; columns of these names are replaced.

    ``phrases`` are all places of phrases, ``spans`` all chains that cover enough of their
    template; words count from 0.
    """
    docs = docs.drop(*REPORT)
    automaton = send(docs.sparkSession, LicenseAutomaton(phrases, templates))
    schema = widened(docs, ", ".join(f"{name} {kind}" for name, kind in REPORT.items()))
    return docs.mapInArrow(_scan(automaton, min_run, max_gap, min_cover), schema)
