"""Second opinions, stated as rules over all pairs instead of as passes over the log."""

from __future__ import annotations

import numpy as np


def _before(a, b):
    """Order inside a user: time, then sequence."""
    return (a[0], a[1]) < (b[0], b[1])


def sessions_of_user(records, span_s=600):
    """Sessions of one user from ``(ms, seq, query, doc)`` records.

    Returns ``{(query, start ms, start seq): [(refinement, doc), ...]}`` with all
    starts, also those without refinements. Record j belongs to start i if it is later,
    no repeat of its predecessor, of another query, and at most the span away.
    """
    records = sorted(records)
    distance = lambda i, j: (records[j][0] - records[i][0]) // 1000
    fresh = [j for j, r in enumerate(records) if r[2:] != (records[j - 1][2:] if j else ("", ""))]
    candidates = [j for j in fresh if records[j][2] != (records[j - 1][2] if j else "")]

    def later_starts(own):
        """The first candidate, and the starts among those beyond its span."""
        if not own:
            return []
        return own[:1] + later_starts([j for j in own if distance(own[0], j) > span_s])

    starts = [i for q in {records[j][2] for j in candidates} for i in later_starts([j for j in candidates if records[j][2] == q])]
    return {
        (records[i][2], *records[i][:2]): [
            records[j][2:] for j in fresh
            if _before(records[i], records[j]) and distance(i, j) <= span_s and records[j][2] != records[i][2]
        ]
        for i in starts
    }


def sessions(records, span_s=600):
    """The same for ``(user, ms, query, doc)`` records; the user is put in front of the key."""
    placed = [(user, (ms, seq, query, doc)) for seq, (user, ms, query, doc) in enumerate(records)]
    return {
        (user, *key): rows
        for user in {u for u, _ in placed}
        for key, rows in sessions_of_user([r for u, r in placed if u == user], span_s).items()
    }


def session_rows(records, span_s=600):
    return sorted(
        (f"{user}_{seq}", user, query, refinement, doc)
        for (user, query, _, seq), rows in sessions(records, span_s).items()
        for refinement, doc in rows
    )


def absorption_by_paths(co_occ, docs, epsilon, steps):
    """Probability of being at each document after ``steps`` steps, for one query.

    ``co_occ`` is ``{(a, b): n}``, ``docs`` is ``{(ref, doc): n}``. The share of a walk that
    is still at each refinement is carried forward step by step; what leaves for a
    document stays there. Returns ``{(ref, doc): p}``.
    """
    both = {}
    for (a, b), n in co_occ.items():
        both[a, b] = both.get((a, b), 0) + n
        both[b, a] = both.get((b, a), 0) + n
    refs = sorted({a for a, _ in both})
    beside = {r: {b: n for (a, b), n in both.items() if a == r} for r in refs}
    clicked = {r: {d: n for (a, d), n in docs.items() if a == r} for r in refs}

    def shares(r):
        weights = {("ref", b): (1 - epsilon) * n / sum(beside[r].values()) for b, n in beside[r].items()}
        weights |= {("doc", d): epsilon * n / sum(clicked[r].values()) for d, n in clicked[r].items()}
        weights["topic", ""] = 1 / len(refs)
        return {k: w / sum(weights.values()) for k, w in weights.items()}

    one_step = {r: shares(r) for r in refs}
    absorbed = {}
    for origin in refs:
        at = {origin: 1.0}
        for _ in range(steps):
            onward = {}
            for r, share in at.items():
                for (kind, name), p in one_step[r].items():
                    target = onward if kind == "ref" else absorbed if kind == "doc" else {}
                    key = name if kind == "ref" else (origin, name)
                    target[key] = target.get(key, 0.0) + share * p
            at = onward
    return absorbed


def is_complete_link(similarity, clusters, min_clusters):
    """Whether clusters can come from complete-link merging, and where it may stop.

    Replays the merges as a choice of maxima over cross blocks of the matrix: at each
    step the two groups whose block has the greatest minimum join, the later pair of
    equals first, and the group takes the place of its later member.
    """
    matrix = np.asarray(similarity, float)
    groups = {i: frozenset([i]) for i in range(len(matrix))}
    while len(groups) > min_clusters:
        blocks = {
            (hi, lo): matrix[np.ix_(sorted(groups[hi]), sorted(groups[lo]))].min()
            for hi in groups for lo in groups if lo < hi
        }
        greatest = max(blocks.values())
        if greatest <= 0:
            break
        hi, lo = max(pair for pair, value in blocks.items() if value == greatest)
        groups[hi] = groups[hi] | groups.pop(lo)
    return {frozenset(c) for c in clusters} == set(groups.values())
