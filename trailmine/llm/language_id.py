"""Language of texts by words first, then ever shorter character n-grams.

A word that the model knows scores its log frequency in each language. An unknown word
falls back to its 5-grams; if the model knows none of them, to its 4-grams, and so on.
The n-grams of the longest order with a known one count, as their mean log frequency. The
language with the largest sum wins; ties go to the first name. The score is the share of
that language after the sums are brought to ``SCORED_WORDS`` words at most.

The model is fitted on a bounded sample: up to ``rows_per_language`` rows of each language,
chosen by a hash of doc_id. It has room for ``max_words`` words and for ``max_grams`` n-grams
of each order, in equal shares: each language puts in its own most frequent ones, down to those
seen once, so that a small language keeps its words beside large ones. What one language put in
is known to all. Prediction covers every whole text and sees the text alone.

Texts are lower-cased by Unicode; words are runs of letters, where all characters beyond
ASCII count as letters. A text that is null or holds no letter is ``und`` with score 0, as
is every text if there is nothing to learn from. Rows with null language are not learned
from. More than ``MAX_LANGUAGES`` languages are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmine.llm.sending import send
from trailmine.llm.text import Words, mix, slices, widened, words_of
from trailmine.storage import materialise

ROWS_PER_LANGUAGE, MAX_WORDS, MAX_GRAMS = 2000, 50_000, 20_000
MAX_LANGUAGES = 2000
ORDERS = (5, 4, 3, 2, 1)
SCORED_WORDS = 20
SMOOTHING = 0.5
UNKNOWN = "und"

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_GAP = 10  # code that stands between words


def _distinct(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of lower-cased texts, their distinct hashes, a place of each and the number of each word."""
    words = words_of(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), LETTERS)
    hashes, place, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    return words, hashes, place, number


def _grams(words: Words, places: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of character n-grams of the words at ``places``, and the word of each.

    A word has a gap on both sides, which an n-gram of two or more may hold at its ends.
    """
    sizes = words.ends[places] - words.starts[places]
    total = int(sizes.sum()) + len(places) + 1
    data = np.full(total, _GAP, np.uint8)
    to = np.cumsum(sizes + 1) - sizes
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(to, sizes) + inner] = words.data[np.repeat(words.starts[places], sizes) + inner]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.uint64)
    gap = codes == _GAP
    word = np.cumsum(gap) - 1
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    valid = np.ones(n, bool)
    state = np.full(n, order, np.uint64)
    for k in range(order):
        state = state * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
        if 0 < k < order - 1 or order == 1:
            valid &= ~gap[k : k + n]
    if order == 2:
        valid &= ~(gap[:n] & gap[1 : n + 1])
    return mix(state[valid]), word[:n][valid]


def _counter(languages: list[str]):
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = np.array([number[x] for x in batch.column("lang").to_pylist()])
            for language in np.unique(own):
                words, hashes, place, which = _distinct(batch.column("text").filter(pa.array(own == language)))
                if not len(hashes):
                    continue
                times = np.bincount(which, minlength=len(hashes))
                tables = [(0, hashes, times)]
                for order in ORDERS:
                    grams, word = _grams(words, place, order)
                    distinct, at = np.unique(grams, return_inverse=True)
                    tables.append((order, distinct, np.bincount(at, times[word], len(distinct)).astype(np.int64)))
                for kind, keys, counts in tables:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(np.full(len(keys), language, np.int32)),
                         pa.array(keys.view(np.int64)), pa.array(counts)], ["kind", "language", "hash", "times"])

    return count


@dataclass
class _Table:
    """Log frequencies of known keys, one row a language."""

    keys: np.ndarray
    logs: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is known, and its column."""
        if not len(self.keys):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return self.keys[at] == hashes, at


@dataclass
class LanguageModel:
    languages: list[str]
    words: _Table
    grams: dict[int, _Table]

    def word_scores(self, words: Words, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Scores of distinct words, one row a language."""
        scores = np.zeros((len(self.languages), len(hashes)))
        known, at = self.words.find(hashes)
        scores[:, known] = self.words.logs[:, at[known]]
        left = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(left):
                break
            table = self.grams[order]
            grams, word = _grams(words, places[left], order)
            found, at = table.find(grams)
            word, at = word[found], at[found]
            times = np.bincount(word, minlength=len(left))
            seen = times > 0
            for row in range(len(self.languages)):
                sums = np.bincount(word, table.logs[row, at], len(left))
                scores[row, left[seen]] = sums[seen] / times[seen]
            left = left[~seen]
        return scores

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, hashes, place, number = _distinct(texts)
        per_word = self.word_scores(words, hashes, place)
        counts = words.counts
        totals = np.stack([np.bincount(words.owner, row[number], len(counts)) for row in per_word], 1)
        has_letters = self._has_letters(texts, words)
        scale = np.minimum(1.0, SCORED_WORDS / np.maximum(counts, 1))
        scaled = totals * scale[:, None]
        share = np.exp(scaled - scaled.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        best = totals.argmax(1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letters.tolist())]
        return names, np.where(has_letters, share[np.arange(len(best)), best], 0.0)

    @staticmethod
    def _has_letters(texts: pa.Array, words: Words) -> np.ndarray:
        ascii_letter = LETTERS & (np.arange(256) < 128)
        sums = np.append(0, np.cumsum(ascii_letter[words.data]))
        plain = sums[words.ends] > sums[words.starts]
        found = np.bincount(words.owner, plain, len(words.counts)) > 0
        for row in np.flatnonzero(~found & (words.counts > 0)):
            found[row] = any(c.isalpha() for c in texts[int(row)].as_py())
        return found


def fit_language_model(
    rows: DataFrame,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> LanguageModel | None:
    """A model of the labelled ``rows`` (``doc_id``, ``text``, ``lang``); None without any."""
    rows = rows.filter("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    share = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, rows_per_language / sizes[name]))))
    drawn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
    counted = rows.filter(drawn).mapInArrow(_counter(languages), "kind int, language int, hash long, times long")
    counted = materialise(counted.groupBy("kind", "language", "hash").agg(F.sum("times").alias("times")), "language-counts")
    sums = {(r["kind"], r["language"]): r["times"] for r in counted.groupBy("kind", "language").agg(F.sum("times").alias("times")).collect()}
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("times"), "hash"))
    tables = {}
    for kind in (0, *ORDERS):
        own = counted.filter(F.col("kind") == kind)
        room = max(1, (max_words if kind == 0 else max_grams) // len(languages))
        top = own.withColumn("rank", rank).filter(F.col("rank") <= room).select("hash").distinct()
        found = own.join(top, "hash").select("hash", "language", "times").toArrow()
        raw = np.asarray(found.column("hash").combine_chunks(), dtype=np.int64).view(np.uint64)
        keys, at = np.unique(raw, return_inverse=True)
        times = np.zeros((len(languages), len(keys)))
        times[np.asarray(found.column("language").combine_chunks(), dtype=np.int64), at] = np.asarray(found.column("times").combine_chunks(), dtype=np.int64)
        total = np.array([[sums.get((kind, i), 0)] for i in range(len(languages))])
        tables[kind] = _Table(keys, np.log((times + SMOOTHING) / (total + SMOOTHING * (len(keys) + 1))))
    return LanguageModel(languages, tables.pop(0), tables)


def identify_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    sent = send(docs.sparkSession, model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent()
        for batch in slices(batches, "text", 2 << 20):
            if own is None:
                names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                names, scores = own.predict(batch.column("text"))
            yield batch.append_column("lang_pred", pa.array(names, pa.string())).append_column("score", pa.array(scores))

    return docs.mapInArrow(predict, widened(docs, "lang_pred string, score double"))
