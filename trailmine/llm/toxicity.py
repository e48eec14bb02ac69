"""Toxicity as ordered severity grades, by cumulative-link regression on words.

The model has one weight for each of a bounded number of words, shared by all thresholds,
and an increasing threshold between each two neighbouring grades:
``P(grade <= j) = sigmoid(threshold[j] - weights . log(1 + counts))``. Its output is the
expected severity, ``sum of P(grade > j)``.

Labels may hold grades 0, 1, 2, ... or mere flags 0 and 1. Flags are spread to grades 0 to
3: a flagged document takes a grade by how many words it has that stand almost only in
flagged documents, cut at the terciles of the flagged sample.

The model is fitted on a bounded sample, at most ``max_rows`` labelled documents of either
kind (flagged or not), chosen by a hash of doc_id, and weighted to the shares in all
labels. Words are kept as features if a chi-square test finds them tied to the flag, the
strongest ``max_features`` of them. Scoring covers every whole text.

A null or empty text has no features and gets what the thresholds say. Null labels are not
learned from; of several labels of a document the largest counts. Without labels of both
kinds every document has severity 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.llm.sending import send
from trailmine.llm.text import ALPHANUMERIC, slices, widened, words_of
from trailmine.storage import materialise

MAX_ROWS, MAX_FEATURES = 10_000, 4096
CHI_SQUARE = 25.0
MIN_DOCUMENTS = 4
TELLING = 0.9  # share of flagged documents among those of a telling word
STEPS, RATE, PENALTY = 500, 0.1, 1e-6


@dataclass
class ToxicityModel:
    words: np.ndarray  # hashes, sorted
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, features: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold, from weighted sums."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - features[:, None], -500, 500)))


def _features(words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and count of each feature that occurs."""
    if not len(vocabulary) or not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == words.hashes)
    text = np.searchsorted(words.first, known, "right") - 1
    pairs, times = np.unique(text * len(vocabulary) + at[known], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), times


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = words_of(batch.column("text"), ALPHANUMERIC)
        flagged = np.asarray(batch.column("label")) > 0
        order = np.lexsort([words.owner, words.hashes])
        hashes, owner = words.hashes[order], words.owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        distinct, at = np.unique(hashes, return_inverse=True)
        bad = np.bincount(at, flagged[owner], len(distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(distinct.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(distinct)) - bad)],
            ["word", "bad", "good"])


def fit_thresholds(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray,
                   importance: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood (Adam over the whole sample)."""
    levels = int(grades.max())
    share = np.array([importance[grades <= j].sum() for j in range(levels)]) / importance.sum()
    start = np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    steps = np.log(np.maximum(np.diff(start), 1e-3))
    state = np.concatenate([np.zeros(n_features), start[:1], steps])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    weight = importance / importance.sum()
    each = np.arange(len(grades))

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[n_features] + np.append(0, np.cumsum(np.exp(x[n_features + 1 :])))

    for step in range(1, STEPS + 1):
        cuts = thresholds(state)
        linear = np.bincount(rows, state[columns] * values, len(grades))
        below = 1 / (1 + np.exp(np.clip(linear[:, None] - cuts[None, :], -500, 500)))
        padded = np.concatenate([np.zeros((len(grades), 1)), below, np.ones((len(grades), 1))], 1)
        slope = np.concatenate([np.zeros((len(grades), 1)), below * (1 - below), np.zeros((len(grades), 1))], 1)
        chance = np.maximum(padded[each, grades + 1] - padded[each, grades], 1e-12)
        upper, lower = weight * slope[each, grades + 1] / chance, weight * slope[each, grades] / chance
        of_linear = upper - lower  # gradient of the negative log likelihood
        of_cuts = np.zeros(levels + 2)
        np.add.at(of_cuts, grades + 1, -upper)
        np.add.at(of_cuts, grades, lower)
        of_cuts = of_cuts[1:-1]
        gradient = np.zeros_like(state)
        gradient[:n_features] = np.bincount(columns, of_linear[rows] * values, n_features) + PENALTY * state[:n_features]
        gradient[n_features] = of_cuts.sum()
        gradient[n_features + 1 :] = np.cumsum(of_cuts[::-1])[::-1][1:] * np.exp(state[n_features + 1 :])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        state = state - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return state[:n_features], thresholds(state)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic",
                 max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> ToxicityModel | None:
    """A model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id`` and the label); None if nothing can be learned."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    total = known.agg(F.count_if(F.col("label") > 0).alias("bad"), F.count_if(F.col("label") <= 0).alias("good"), F.max("label").alias("most")).first()
    if not total["bad"] or not total["good"]:
        return None
    drawn = [known.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for c in (F.col("label") > 0, F.col("label") <= 0)]
    # Bounded: at most 2 * max_rows ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
    sample = materialise(sample.dropDuplicates(["doc_id"]), "toxicity-sample")
    sizes = {r["flag"]: r["count"] for r in sample.groupBy((F.col("label") > 0).alias("flag")).count().collect()}
    n_bad, n_good = sizes.get(True, 0), sizes.get(False, 0)
    if not n_bad or not n_good:
        return None
    found = sample.mapInArrow(_document_counts, "word long, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n = n_bad + n_good
    tie = (F.col("bad") * float(n_good) - F.col("good") * float(n_bad)) ** 2 * float(n)
    both = F.col("bad") + F.col("good")
    chi = tie / (float(n_bad) * float(n_good) * both * (F.lit(n) - both + 1e-9))
    chosen = (found.filter(both >= MIN_DOCUMENTS).withColumn("chi", chi).filter(F.col("chi") >= CHI_SQUARE)
              .orderBy(F.desc("chi"), "word").limit(max_features).collect())
    if not chosen:
        return None
    hashes = np.array([r["word"] for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    vocabulary = hashes[order]
    bad, good = (np.array([r[c] for r in chosen], float)[order] for c in ("bad", "good"))
    telling = bad / n_bad >= TELLING * (bad / n_bad + good / n_good)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, feature, times = _features(words_of(batch.column("text"), ALPHANUMERIC), sent.value)
            first = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(first, pa.array(feature)),
                 pa.ListArray.from_arrays(first, pa.array(times))], ["doc_id", "label", "features", "times"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "label", "text").mapInArrow(vectors, f"doc_id {kind}, label int, features array<long>, times array<long>")
    table = rows.orderBy("doc_id").collect()
    label_of = np.array([max(0, r["label"]) for r in table])
    row = np.repeat(np.arange(len(table)), [len(r["features"]) for r in table])
    column = np.array([f for r in table for f in r["features"]], np.int64)
    times = np.array([t for r in table for t in r["times"]], np.int64)
    grades = label_of
    if total["most"] <= 1:
        strength = np.bincount(row, times * telling[column], len(table))
        cuts = np.quantile(strength[label_of > 0], [1 / 3, 2 / 3])
        grades = np.where(label_of > 0, 1 + (strength[:, None] > cuts[None, :]).sum(1), 0)
    _, grades = np.unique(grades, return_inverse=True)
    if grades.max() < 1:
        return None
    importance = np.where(label_of > 0, total["bad"] / n_bad, total["good"] / n_good)
    weights, thresholds = fit_thresholds(row, column, np.log1p(times), grades, importance, len(vocabulary))
    return ToxicityModel(vocabulary, weights, thresholds)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (the likeliest) and ``p_toxic`` (P(grade > 0)).

    Columns of these names are replaced.
    """
    docs = docs.drop("severity", "grade", "p_toxic")
    sent = send(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent()
        for batch in slices(batches, "text"):
            n = batch.num_rows
            above = np.zeros((n, 1))
            if own is not None:
                text, feature, times = _features(words_of(batch.column("text"), ALPHANUMERIC), own.words)
                above = own.exceed(np.bincount(text, own.weights[feature] * np.log1p(times), n))
            edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
            batch = batch.append_column("severity", pa.array(above.sum(1)))
            batch = batch.append_column("grade", pa.array((edges[:, :-1] - edges[:, 1:]).argmax(1).astype(np.int32)))
            yield batch.append_column("p_toxic", pa.array(above[:, 0]))

    return docs.mapInArrow(score, widened(docs, "severity double, grade int, p_toxic double"))
