"""Plain restatements of the operators' rules, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

BLANK_WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ascii_lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def blank_words(text: str | None) -> list[str]:
    return BLANK_WORD.findall(ascii_lower(text))


def alnum_words(text: str | None) -> list[str]:
    return ALNUM_WORD.findall(ascii_lower(text))


def shingle_set(text: str | None, width: int) -> set[tuple[str, ...]]:
    words = blank_words(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def near_components(docs: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, int]:
    """Smallest reachable id of each document."""
    sets = {i: shingle_set(t, width) for i, t in docs}
    label = {i: i for i in sets}
    ids = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    links = []
    for at, x in enumerate(ids):
        for y in ids[at + 1 :]:
            if 100 * len(sets[x]) < percent * len(sets[y]):
                break
            common = len(sets[x] & sets[y])
            if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                links.append((x, y))
    changed = True
    while changed:
        changed = False
        for x, y in links:
            least = min(label[x], label[y])
            changed |= label[x] != least or label[y] != least
            label[x] = label[y] = least
    return label


def contamination(text: str | None, items: list[tuple[str, str]], width: int = 10) -> tuple[set[int], set[str]]:
    """Hit word places and items."""
    words, hit, found = alnum_words(text), set(), set()
    windows = [(item, w[k : k + min(width, len(w))]) for item, t in items for w in [alnum_words(t)] if w
               for k in range(max(1, len(w) - width + 1))]
    for item, window in windows:
        for k in range(len(words) - len(window) + 1):
            if words[k] == window[0] and words[k : k + len(window)] == window:
                hit.update(range(k, k + len(window)))
                found.add(item)
    return hit, found


def phrase_places(text: str | None, phrases: dict[str, str]) -> list[tuple[int, str]]:
    words = alnum_words(text)
    return sorted((k, label) for p, label in phrases.items() for w in [p.split()]
                  for k in range(len(words) - len(w) + 1) if words[k : k + len(w)] == w)


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def pieces(text: str) -> list[list[str]]:
    """Lines, each cut behind the blanks that follow a sentence (but those before a line end)."""
    out = []
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        own, piece = [], ""
        for k, c in enumerate(line):
            piece += c
            blanks = piece[len(piece.rstrip(" \t")) :]
            if blanks and piece.rstrip(" \t")[-1:] in (".", "!", "?") and line[k + 1 : k + 2] not in ("", " ", "\t", "\n"):
                own.append(piece)
                piece = ""
        out.append(own + [piece] * (piece != ""))
    return out


def without_repeats(docs: list[tuple[int, str | None]], need: int = 5) -> dict[int, list[tuple[str, bool]]]:
    """The pieces of each text, and which an earlier place has; ids are distinct.

    A piece goes if its line, or a stretch of ``need`` words that begins or ends with it in
    its line, stands at an earlier place.
    """
    first: dict[str, tuple[int, int, int]] = {}

    def stretches(own: list[str], k: int):
        words = [p.lower().split() for p in own]
        yield 0, len(own)
        if words[k]:
            yield from ((k, j) for j in range(k + 1, len(own) + 1) if sum(map(len, words[k:j])) >= need and not sum(map(len, words[k : j - 1])) >= need)
            yield from ((j, k + 1) for j in range(k + 1) if sum(map(len, words[j : k + 1])) >= need and not sum(map(len, words[j + 1 : k + 1])) >= need)

    parsed = {i: pieces(t or "") for i, t in sorted(docs)}
    for step in ("find", "cut"):
        out = {}
        for i, lines in parsed.items():
            out[i] = []
            for at, own in enumerate(lines):
                for k, piece in enumerate(own):
                    gone = False
                    for a, b in stretches(own, k):
                        key = " ".join(" ".join(own[a:b]).lower().split())
                        if key:
                            gone |= first.setdefault(key, (i, at, a)) < (i, at, a)
                    out[i].append((piece, gone))
    return out


def kept_text(pieces: list[tuple[str, bool]]) -> str:
    return "".join(p for p, gone in pieces if not gone)


LETTER_WORD = re.compile("[A-Za-z\x80-\U0010ffff]+")


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of a word; beyond single characters its borders count as one."""
    padded = word if order == 1 else f" {word} "
    return [padded[k : k + order] for k in range(len(padded) - order + 1)]


class Languages:
    """Words first, then shorter and shorter n-grams, of all that was seen."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.names = sorted({lang for _, lang in rows})
        self.times = {(kind, lang): Counter() for kind in range(6) for lang in self.names}
        for text, lang in rows:
            for word in LETTER_WORD.findall(text.lower()):
                self.times[0, lang][word] += 1
                for order in range(1, 6):
                    self.times[order, lang].update(grams_of(word, order))
        self.known = {kind: set().union(*(self.times[kind, lang] for lang in self.names)) for kind in range(6)}

    def largest_table(self, kind: int) -> int:
        return max(len(self.times[kind, lang]) for lang in self.names)

    def _log(self, kind: int, key: str, lang: str) -> float:
        own = self.times[kind, lang]
        return math.log((own[key] + 0.5) / (own.total() + 0.5 * (len(self.known[kind]) + 1)))

    def _word(self, word: str, lang: str) -> float:
        if word in self.known[0]:
            return self._log(0, word, lang)
        for order in (5, 4, 3, 2, 1):
            found = [g for g in grams_of(word, order) if g in self.known[order]]
            if found:
                return sum(self._log(order, g, lang) for g in found) / len(found)
        return 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        words = Counter(LETTER_WORD.findall(text.lower()))
        scale = min(1.0, 20 / words.total())
        sums = [scale * sum(n * self._word(w, lang) for w, n in words.items()) for lang in self.names]
        best = max(sums)
        return self.names[sums.index(best)], 1 / sum(math.exp(x - best) for x in sums)


def grade_chances(weights: dict[str, float], thresholds: list[float], text: str | None) -> list[float]:
    """P(grade = j) for each grade."""
    linear = sum(weights[w] * math.log1p(n) for w, n in Counter(alnum_words(text)).items() if w in weights)
    below = [1 / (1 + math.exp(linear - cut)) for cut in thresholds] + [1.0]
    return [b - a for a, b in zip([0.0, *below], below)]


def telling_words(flagged: list[tuple[str | None, bool]]) -> dict[str, bool]:
    """Words tied to the flag by a chi-square test, and whether each is telling."""
    n_bad = sum(flag for _, flag in flagged)
    n_good = len(flagged) - n_bad
    bad, good = Counter(), Counter()
    for text, flag in flagged:
        (bad if flag else good).update(set(alnum_words(text)))
    chosen = {}
    for word in {*bad, *good}:
        a, b = bad[word], good[word]
        rest_bad, rest_good, n = n_bad - a, n_good - b, len(flagged)
        rest = rest_bad + rest_good
        chi = n * (a * rest_good - b * rest_bad) ** 2 / (n_bad * n_good * (a + b) * rest) if rest else 0.0
        if a + b >= 4 and chi >= 25:
            chosen[word] = a / n_bad >= 0.9 * (a / n_bad + b / n_good)
    return chosen


def quote_level(line: str) -> tuple[int, str]:
    """Signs of a line, each with a blank before it or none, and what follows."""
    at = level = 0
    while True:
        sign = at + 1 if line[at : at + 1] in (" ", "\t") else at
        if line[sign : sign + 1] != ">":
            return level, line[at:].removeprefix(" ") if level else line
        at, level = sign + 1, level + 1


def _normal(text: str) -> str:
    return re.sub("[ \t\r\n\f]+", " ", text.lower()).strip(" ")


def _units_of(passages: list[tuple[int, str]], least: int) -> list[tuple[int, int, str]]:
    """Level, rank and text of passages, paragraphs and lines."""
    found = []
    for level, text in passages:
        found.append((level, 1, text))
        for rank, border in ((2, "\n[ \t\f]*\n"), (3, "\n")):
            for part in re.split(border, text):
                if "\n" in part.strip(" \t\n\f") or len(_normal(part).split(" ")) >= least:
                    found.append((level, rank, part))
    return [(level, rank, _normal(text)) for level, rank, text in found if _normal(text)]


def _passages(text: str) -> list[tuple[int, str]]:
    lines = [(*quote_level(x), x) for x in re.split("\r\n|\r|\n", text)]
    said = re.compile(r"[ \t]*(On|Am|Le|El)\b.*(wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*$")
    passages: list[tuple[int, list[str]]] = []
    for k, (level, rest, line) in enumerate(lines):
        if level == 0 and said.match(line) and k + 1 < len(lines) and lines[k + 1][0] > 0:
            continue
        if not passages or passages[-1][0] != level:
            passages.append((level, []))
        passages[-1][1].append(rest)
    return [(level, "\n".join(own)) for level, own in passages]


def threads(messages: list[tuple[int, int, str]], least: int) -> list[tuple]:
    """Conversation, turn, own text, parent, root, depth and number of quotations of each message."""
    own, said, parent = [], {}, {}
    for conv, turn, text in messages:
        passages = _passages(text)
        plain = [p for p in passages if p[0] == 0]
        quoted = [p for p in passages if p[0] > 0]
        kept = "\n".join(t for _, t in plain)
        kept = re.sub("^\n+|\n+$", "", re.sub("\n{3,}", "\n\n", kept)) if quoted else text
        own.append((kept, quoted))
        for key in {u[2] for u in _units_of(plain, 1)} | {_normal(kept)}:
            said[conv, key] = min(turn, said.get((conv, key), turn))
    for (conv, turn, _), (_, quoted) in zip(messages, own):
        for level, rank, key in _units_of(quoted, least):
            at = said.get((conv, key), turn)
            if at < turn:
                parent[conv, turn] = max(parent.get((conv, turn), (-99, 0, 0)), (-level, -rank, at))
    rows = []
    for (conv, turn, _), (kept, quoted) in zip(messages, own):
        root, depth = turn, 0
        while (conv, root) in parent:
            root, depth = parent[conv, root][2], depth + 1
        rows.append((conv, turn, kept, parent[conv, turn][2] if (conv, turn) in parent else None, root, depth, len(quoted)))
    return rows
