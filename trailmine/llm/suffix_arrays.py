"""Suffix arrays of byte strings in numpy, and their common prefixes."""

from __future__ import annotations

import numpy as np

WORD = 8  # bytes compared at once


def words_at(data: np.ndarray, extra: int = 0) -> np.ndarray:
    """The 8 bytes from each place on as a number that sorts like them; zeros stand behind the end.

    ``extra`` more places behind the end are included.
    """
    n = len(data) + extra
    padded = np.zeros(n + WORD, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Places in the order of the bytes that follow them; ``words`` as of :func:`words_at`.

    Larsson-Sadakane: places are sorted by 8 bytes, and then only groups of places that still
    agree are refined, by the group of the place 8, 16, 32, ... bytes ahead, until every place
    is a group of its own. A group is known by the slot of its first member.
    """
    n = len(words)
    order = np.argsort(words)
    group = np.zeros(n, np.int64 if n >= 1 << 30 else np.int32)  # of each place
    slots, keys = np.arange(n), words[order]
    span = WORD
    while True:
        new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(keys)))
        group[order[slots]] = np.repeat(slots[heads], sizes)
        open_ = np.repeat(sizes > 1, sizes)
        slots = slots[open_]
        if not len(slots):
            return order
        places = order[slots]
        ahead = places + span
        rank = group.take(ahead, mode="clip") + (span + 1)
        behind = np.flatnonzero(ahead >= n)
        rank[behind] = span + n - ahead[behind]  # behind the end, the shorter rest comes first
        keys = group.take(places).astype(np.int64) * (n + span + 1) + rank
        sort = np.argsort(keys)
        order[slots] = places[sort]
        keys = keys[sort]
        span *= 2


def common_prefixes(words: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each place of ``order`` shares with the one before it, up to ``most``.

    ``words`` must go on ``most`` places behind the last of ``order``. Kasai: from a place to
    the next of the text the common prefix loses one byte at most, so a place begins to
    compare where its left neighbour stopped, less one. The text is walked in many lanes side
    by side, eight bytes a step.
    """
    n = len(order)
    if not n:
        return np.zeros(0, np.int64)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    shared = np.zeros(n, np.int64)
    length = max(64, int(np.sqrt(n) / 8))
    place = np.arange(0, n, length)
    end = np.minimum(place + length, n)
    known = np.zeros(len(place), np.int64)
    while len(place):
        other = before[place]
        first = other < 0
        differ = words[place + known] ^ words[np.maximum(other, 0) + known]
        more = np.where(differ == 0, WORD, 0)
        rest = np.flatnonzero(differ)
        if len(rest):
            bits = differ[rest]
            count = np.zeros(len(rest), np.int64)
            for k in range(1, WORD):
                count += bits < (np.uint64(1) << np.uint64(8 * (WORD - k)))
            more[rest] = count
        known = np.where(first, 0, np.minimum(known + more, most))
        done = first | (more < WORD) | (known == most)
        at = place[done]
        shared[at] = known[done]
        place = place + done
        known = np.where(done, np.maximum(known - 1, 0), known)
        left = place < end
        if not left.all():
            place, end, known = place[left], end[left], known[left]
    return shared[order]
