"""Repeated lines, sentences or paragraphs, found by digests of whole units over all documents.

Every line is a unit, and with ``unit="sentence"`` every sentence inside a line as well: lines
end behind ``\\n``, sentences behind the blanks that follow ``.``, ``!`` or ``?``. So the pieces of
a text follow each other without a gap, no word is outside a unit, and a passage that begins
or ends inside a line is found up to its first and last sentence. ``unit="line"`` leaves sentences
out; ``"paragraph"`` cuts behind empty lines instead.

A unit is normalised by lower case and single blanks, and known by a 128-bit digest of that.
Sentences of one or two words repeat by chance, so one of fewer than ``SENTENCE_WORDS`` words is
hashed together with the sentences behind it in its line, as many as hold that many words, and
once more with those before it; it is repeated if either stretch is. Lines have no such rule,
and are hashed as a whole only where their sentences do not stand for them already. (Sentences
end before blanks and TABs alone; a line with other blanks there is one piece, and known as such.)

For each digest that occurs more than once, the occurrence of the smallest
``(doc_id, text hash, place)`` stays and all others go. The digests are counted with a combined
aggregate, so that a line of half of all documents is a sum and not a group; only digests that
repeat are joined back.

Units without words always stay, unless their line goes. Null and empty texts stay as they are.
A null doc_id ranks before all others. Rows of equal doc_id and text are one document: all of
them keep or lose the same units. A text of which all units go becomes empty; its row stays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.llm.text import slices, widened
from trailmine.storage import materialise

SENTENCE_WORDS = 5  # hashed at least where a sentence is no line of its own
PASSAGE_WORDS = 25  # a removed stretch of so many words counts as a passage
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n\s*")
_LINE = re.compile(r"\n")
_SENTENCE = re.compile(r"(?<=[.!?])[ \t]++(?!\n)")
UNITS = "doc_id long, text_hash long, place int, start int, stop int, digest binary"


def _cut_behind(border: re.Pattern[str], text: str, begin: int, end: int) -> list[tuple[int, int]]:
    out = []
    for found in border.finditer(text, begin, end):
        out.append((begin, found.end()))
        begin = found.end()
    return out + [(begin, end)] * (begin < end)


def pieces_of(text: str, unit: str = "sentence") -> list[list[tuple[int, int]]]:
    """Start and end, in characters, of the pieces of each line (or paragraph)."""
    lines = _cut_behind(_PARAGRAPH if unit == "paragraph" else _LINE, text, 0, len(text))
    return [_cut_behind(_SENTENCE, text, a, b) if unit == "sentence" else [(a, b)] for a, b in lines]


def hashed_units(text: str, unit: str = "sentence") -> Iterator[tuple[int, int, int, list[str]]]:
    """Units of a text: where the hashed stretch begins, what goes if it is a repeat, its words."""
    for pieces in pieces_of(text, unit):
        words = [text[a:b].lower().split() for a, b in pieces]
        alone = [False] * len(pieces)  # hashed as a sentence, with neighbours or without
        for k, (start, stop) in enumerate(pieces if len(pieces) > 1 else ()):
            if not words[k]:
                continue
            ahead, last = list(words[k]), k
            while len(ahead) < SENTENCE_WORDS and last + 1 < len(pieces):
                last += 1
                ahead += words[last]
            if len(ahead) >= SENTENCE_WORDS:
                alone[k] = True
                yield start, start, stop, ahead
            back, first = list(words[k]), k
            while len(back) < SENTENCE_WORDS and first > 0:
                first -= 1
                back = words[first] + back
            if first < k and len(back) >= SENTENCE_WORDS:
                alone[k] = True
                yield pieces[first][0], start, stop, back
        # All stretches of a repeated line are repeats themselves, so if they leave none of
        # its pieces out, the line as a whole adds nothing.
        if any(words) and not all(alone):
            yield pieces[0][0], pieces[0][0], pieces[-1][1], [w for own in words for w in own]


def _digests(unit: str):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, places, starts, stops, found = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for place, start, stop, words in hashed_units(text or "", unit):
                    rows.append(row)
                    places.append(place)
                    starts.append(start)
                    stops.append(stop)
                    found.append(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest())
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take), *(pa.array(x, pa.int32()) for x in (places, starts, stops)),
                 pa.array(found, pa.binary())],
                ["doc_id", "text_hash", "place", "start", "stop", "digest"])

    return digests


def _lost(pieces: list[tuple[int, int]], spans: list[dict]) -> tuple[list[tuple[int, int]], int]:
    """The stretches that go, of neighbouring pieces inside any of the spans, and the number of pieces."""
    out: list[tuple[int, int]] = []
    n = end = at = 0
    spans = sorted((s["start"], s["stop"]) for s in spans)
    for start, stop in pieces:
        while at < len(spans) and spans[at][0] <= start:
            end = max(end, spans[at][1])
            at += 1
        if stop <= end:
            n += 1
            if out and out[-1][1] == start:
                out[-1] = (out[-1][0], stop)
            else:
                out.append((start, stop))
    return out, n


def _cut(unit: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in slices(batches, "text"):
            texts, removed, counts = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
                pieces = [p for line in pieces_of(text or "", unit) for p in line]
                lost, n = _lost(pieces, spans or [])
                words = [len(text[a:b].split()) for a, b in lost]
                if lost:
                    text = "".join(text[a:b] for a, b in zip([0, *(b for _, b in lost)], [*(a for a, _ in lost), len(text)]))
                texts.append(text)
                removed.append([{"start": a, "stop": b} for a, b in lost])
                counts.append((len(pieces), n, max(words, default=0), sum(w >= PASSAGE_WORDS for w in words)))
            for name, column in (("text", texts), ("removed", removed)):
                place = batch.schema.get_field_index(name)
                kind = span if name == "removed" else batch.schema.field(place).type
                batch = batch.set_column(place, pa.field(name, kind), pa.array(column, kind))
            for k, name in enumerate(COUNTS):
                batch = batch.append_column(name, pa.array([c[k] for c in counts], pa.int64()))
            yield batch

    return cut


COUNTS = ("n_units", "n_removed", "longest_removed", "n_passages")


def remove_repeats(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, plus what was cut.

    Needs ``doc_id`` and ``text``; all columns stay. Adds ``removed``, an array of the
    stretches ``(start, stop)`` that went, in characters of the original text and in order,
    ``n_units``, the number of all pieces of the original text, ``n_removed``, that of those
    that went, ``longest_removed``, the words of the longest stretch, and ``n_passages``, the
    number of stretches of ``PASSAGE_WORDS`` words or more, which tells a passage from a stray
    line. Columns of these names are replaced.
    """
    docs = docs.drop("removed", *COUNTS)
    names = docs.columns
    own = docs.select("*", F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__hash"))
    hashed = own.select(F.col("__doc").alias("doc_id"), F.col("__hash").alias("text_hash"), "text")
    units = materialise(hashed.mapInArrow(_digests(unit), UNITS), "units")
    place = F.struct("doc_id", "text_hash", "place")
    counted = units.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    # Written down, so that the join of a frequent line can be split.
    repeated = materialise(counted.filter("n > 1").drop("n"), "repeated-units")
    later = units.join(repeated, "digest").filter(~place.eqNullSafe(F.col("first")))
    removed = later.groupBy(F.col("doc_id").alias("__of"), F.col("text_hash").alias("__text")).agg(
        F.collect_set(F.struct("start", "stop")).alias("removed"))
    joined = own.join(removed, own["__doc"].eqNullSafe(removed["__of"]) & (own["__hash"] == removed["__text"]), "left")
    joined = joined.select(*names, "removed")
    return joined.mapInArrow(_cut(unit), widened(joined, ", ".join(f"{c} long" for c in COUNTS)))
