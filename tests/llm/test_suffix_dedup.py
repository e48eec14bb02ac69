"""Suffix arrays and the removal of repeated bytes against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import DOCS, ODD_TEXTS, SF_DIR, documents, no_docs, odd_docs  # noqa: F401

from trailmine.llm import queries, suffix_arrays, suffix_dedup

_BYTES = st.one_of(st.lists(st.integers(0, 2), max_size=120), st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 20)).map(lambda x: x[0] * x[1]))


@settings(max_examples=300, deadline=None)
@given(_BYTES, st.integers(1, 70))
def test_order_and_common_prefixes(values, most):
    data = np.array(values, np.uint8)
    raw = data.tobytes()
    words = suffix_arrays.words_at(data, most + 8)
    order = suffix_arrays.suffix_array(words[: len(data)])
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    padded = raw + bytes(most)
    want = [0] * min(1, len(raw))
    for a, b in zip(order.tolist(), order[1:].tolist()):
        want.append(next((k for k in range(most) if padded[a + k] != padded[b + k]), most))
    assert suffix_arrays.common_prefixes(words, order, most).tolist() == want


def _brute(docs, width: int = 50) -> list[tuple]:
    """doc_id, removed spans and kept bytes, window by window; null counts as the smallest id."""
    first: dict[bytes, int] = {}
    docs = [(suffix_dedup.LEAST if i is None else i, (t or "").encode()) for i, t in docs]
    for i, raw in docs:
        for k in range(len(raw) - width + 1):
            window = raw[k : k + width]
            first[window] = min(first.get(window, i), i)
    out = []
    for i, raw in docs:
        gone = np.zeros(len(raw) + 2, bool)
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < i:
                gone[k + 1 : k + width + 1] = True
        edge = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[1:-1]])
        out.append((i, list(zip(edge[::2], edge[1::2])), kept))
    return sorted(out)


def _removed(docs, width: int = 50) -> list[tuple]:
    rows = suffix_dedup.remove_repeated_bytes(docs, width).collect()
    return sorted((suffix_dedup.LEAST if r["doc_id"] is None else r["doc_id"], [(s["start"], s["stop"]) for s in r["removed"]], bytes(r["kept"])) for r in rows)


def test_removal_equals_brute_force(spark, documents):
    got = queries.op12_suffix_dedup(spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == len(documents) and (got.n_removed > 0).any()
    for i, spans, kept in _brute(list(zip(documents.doc_id, documents.text))):
        row = got.loc[i]
        assert (row.n_removed, row.n_spans, row.n_bytes) == (sum(b - a for a, b in spans), len(spans), len(kept) + row.n_removed)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def _mixed(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcd \né") for _ in range(rnd.randint(10, 300))) for _ in range(8)]
    docs = []
    for _ in range(50):
        body = ""
        for _ in range(rnd.randint(0, 5)):
            kind = rnd.random()
            if kind < 0.5:
                part = rnd.choice(pool)
                body += part[rnd.randint(0, len(part)) :]
            elif kind < 0.6:
                body += "ab" * rnd.randint(0, 80)
            elif kind < 0.65:
                body += "x\0" * rnd.randint(0, 3000)
            else:
                body += "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 80)))
        docs.append((rnd.choice([None, *range(30)]), body))
    return docs


@pytest.mark.parametrize("shard, fan_in, width", [(1 << 22, 4096, 50), (2000, 4096, 50), (900, 2, 50), (3000, 3, 24)])
def test_shards_and_merges_of_all_sizes(spark, monkeypatch, shard, fan_in, width):
    for name, value in (("SHARD_BYTES", shard), ("BUCKET_BYTES", shard), ("PIECE_BYTES", max(shard, 2500)), ("FAN_IN", fan_in)):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = _mixed(shard + width)
    got = _removed(spark.createDataFrame(docs, DOCS).repartition(3), width)
    assert got == _brute(docs, width) and any(spans for _, spans, _ in got)


def test_a_passage_of_many_documents_is_sent_once_a_shard():
    passage = "the quick brown fox jumps over the lazy dog and runs away from the hounds "
    docs = pa.table({"doc_id": list(range(300)), "text": [f"{i * 7919} {passage}{i * 104729}" for i in range(300)]})
    shard = docs.append_column("__doc", docs["doc_id"]).append_column("__hash", docs["doc_id"]).append_column("__shard", pa.array([7] * 300))
    keys = suffix_dedup._tell_keys(50, 1)(shard)
    sent = suffix_dedup._sort_shard(50, 1)(shard, keys).to_pylist()
    local = [r for r in sent if r["bucket"] < 0]
    owners, _, _ = suffix_dedup._unpacked_spans(local[0]["places"])
    assert len(local) == 1 and sorted(set(owners.tolist())) == list(range(1, 300))
    texts = b"".join(bytes(suffix_dedup._unpacked(r["texts"], "u1")[0]) for r in sent if r["bucket"] >= 0)
    assert texts.count(passage[4:60].encode()) <= 3 and len(texts) < 300 * 250


def test_windows_that_share_a_name(monkeypatch):
    raw = np.frombuffer(b"a" * 50 + b"b" * 50 + b"a" * 50, np.uint8)
    words = suffix_arrays.words_at(raw, 70)
    windows, docs = [np.array([0]), np.array([50, 100])], [np.array([3]), np.array([1, 4])]
    assert [x.tolist() for x in suffix_dedup.merged_least(words, windows, docs, 50)] == [[3], [1, 3]]
    monkeypatch.setattr(suffix_dedup, "_names", lambda words, windows, width: np.zeros(len(windows), np.uint64))
    assert [x.tolist() for x in suffix_dedup.merged_least(words, windows, docs, 50)] == [[3], [1, 3]]


def test_the_text_is_shuffled_once(spark, documents):
    plan = suffix_dedup.remove_repeated_bytes(spark.createDataFrame(documents[["doc_id", "text"]]))
    plan.collect()
    tree = plan._jdf.queryExecution().executedPlan().toString()
    final = tree[: tree.index("Initial Plan")] if "Initial Plan" in tree else tree
    assert final.count("ReusedExchange") >= 2 and final.count("REPARTITION_BY_NUM") - final.count("ReusedExchange") <= 1


def test_removal_from_odd_texts(spark, odd_docs, no_docs):
    got = _removed(odd_docs)
    assert len(got) == len(ODD_TEXTS) and got == _brute(ODD_TEXTS)
    row = suffix_dedup.remove_repeated_bytes(odd_docs.selectExpr("*", "1 as removed", "2 as kept", "3 as shard", "4 as bucket")).first()
    assert row["shard"] == 3 and row["bucket"] == 4
    assert suffix_dedup.remove_repeated_bytes(no_docs).count() == 0
    copies = [(1, "é" * 40), (2, "é" * 40), (2, "é" * 40), (3, "x" + "é" * 40), (None, "y" * 49)]
    assert _removed(spark.createDataFrame(copies, DOCS)) == _brute(copies)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeated_bytes(no_docs, 10)
