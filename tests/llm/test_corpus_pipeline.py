"""The pipeline against brute force, stage by stage."""

from __future__ import annotations

import hashlib
import math

import brute
import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from inputs import DOCS

from trailmine.llm import piece_encoding, queries, text, toxicity

SF_DIR = "/root/testdata/sf0.01"


def _brute_toxic(model: toxicity.ToxicityModel, body: str) -> float:
    weights = dict(zip(model.words.tolist(), model.weights.tolist()))
    counts: dict[int, int] = {}
    for word in brute.alnum_words(body):
        h = text.hash_word(word)
        if h in weights:
            counts[h] = counts.get(h, 0) + 1
    linear = sum(weights[h] * math.log1p(n) for h, n in counts.items())
    return 1 / (1 + math.exp(model.thresholds[0] - linear))


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    want = {i: t for i, t in zip(table.doc_id, table.text) if _brute_toxic(model, t) < queries.TOXIC_FROM}
    assert len(want) < len(table)
    label = brute.near_components(list(want.items()), 5, 80)
    want = {i: t for i, t in want.items() if label[i] == i}
    want = {i: brute.kept_text(p) for i, p in brute.without_repeats(list(want.items())).items()}
    bench = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    items = [(str(i), t) for i, t in zip(bench.item_id, bench.text)]
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [brute.alnum_words(t)] for k in range(max(1, len(w) - 9))}
    width = {len(w) for w in windows}

    def clean(body: str) -> bool:
        words = brute.alnum_words(body)
        return not any(tuple(words[k : k + n]) in windows for n in width for k in range(len(words) - n + 1))

    kept = {i: t for i, t in want.items() if clean(t)}
    assert len(kept) < len(want)
    with open(queries.piece_model(), "rb") as file:
        library = piece_encoding.PieceEncoder(file.read()).library
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: r["text"] for r in got} == kept
    for r in got:
        ids = library.encode(r["text"], add_bos=True, add_eos=True)
        assert r["token_bytes"] == np.array(ids, "<u4").tobytes() and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest() and r["n_chars"] == len(r["text"])


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(30)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.names == docs.schema.names, name


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, 5), (None, "", "en", "s", 0, 5), (2, "a b", "en", "s", 3, 5), (2, "a b", "en", "s", 3, 5)]])
def test_stages_of_odd_documents(spark, rows):
    docs = spark.createDataFrame(rows, DOCS + ", lang string, source string, n_chars long, hits int")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    # Of the repeated row one stays.
    assert docs.count() == (3 if rows else 0)
