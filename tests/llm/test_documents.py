"""Operators on documents against brute force, and on odd input."""

from __future__ import annotations

import hashlib

import brute
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import DOCS, ODD_TEXTS, SF_DIR, documents, no_docs, odd_docs  # noqa: F401

from trailmine.llm import (
    decontaminate,
    language_id,
    license_scan,
    near_dedup,
    piece_encoding,
    queries,
    substring_dedup,
    text,
    toxicity,
)
from trailmine.llm.text import hash_word

WORDS = st.lists(st.sampled_from(["a", "b", "The", "THE", "é", "2", "under", "mit", "\n", "x-y", "  ", "."]), max_size=30).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), WORDS, st.text(max_size=20)), max_size=6), st.integers(1, 40))
def test_words_equal_the_pattern(texts, block):
    before, text.BLOCK_BYTES = text.BLOCK_BYTES, block
    try:
        for inside, plain in ((text.BLANK_SEPARATED, brute.blank_words), (text.ALPHANUMERIC, brute.alnum_words)):
            words = text.words_of(pa.array(texts, pa.string()), inside)
            got = [[words.normal(k).decode() for k in range(a, b)] for a, b in zip(words.first, words.first[1:])]
            assert got == [plain(t) for t in texts]
            flat = [w for own in got for w in own]
            assert len(set(words.hashes.tolist())) == len(set(flat))
            assert [text.hash_word(w) for w in flat] == words.hashes.tolist()
    finally:
        text.BLOCK_BYTES = before


# Near duplicates ---------------------------------------------------------------


def test_near_duplicates_equal_brute_force(spark, documents):
    got = queries.op2_minhash_near_dedup(spark, SF_DIR).toPandas().set_index("doc_id")
    want = brute.near_components(list(zip(documents.doc_id, documents.text)), 2, 80)
    assert len(got) == len(documents)
    assert got.component_id.to_dict() == want
    assert got.n_shingles.to_dict() == {i: len(brute.shingle_set(t, 2)) for i, t in zip(documents.doc_id, documents.text)}
    assert (got.kept == (got.component_id == got.index)).all()


def _edited(rng, words: list[str], share: float) -> str:
    return " ".join(w if rng.random() > share else f"new{rng.integers(1 << 30)}" for w in words)


def test_a_group_of_mixed_links_in_small_blocks(spark, monkeypatch):
    """Copies around the border of similarity, in keys larger than a block."""
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    docs = [(i, _edited(rng, base, rng.choice([0.0, 0.02, 0.05, 0.07]))) for i in range(160)]
    docs += [(1000 + i, " ".join(f"u{i}x{k}" for k in range(90))) for i in range(20)]
    monkeypatch.setattr(near_dedup, "KEY_BLOCK", 16)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 2000)
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(4), 2).toPandas().set_index("doc_id")
    assert got.component_id.to_dict() == brute.near_components(docs, 2, 80)


def test_near_duplicates_of_odd_texts(spark, odd_docs, no_docs):
    got = near_dedup.near_duplicates(odd_docs, 5).toPandas()
    assert len(got) == len(ODD_TEXTS)
    by = {int(i): c for i, c in zip(got.doc_id, got.component_id) if i == i and i is not None}
    assert [by[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] == [1, 2, 3, 4, 4, 6, 7, 7, 7, 10]
    assert got[got.doc_id.isna()].component_id.tolist() == [7]
    assert got[got.doc_id == 12].kept.tolist() == [True, True]
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_distance_is_guaranteed_by_the_keys():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS, dtype=np.uint16)
    for _ in range(300):
        b = a.copy()
        b[rng.choice(near_dedup.SYMBOLS, near_dedup.DISTANCE, replace=False)] += np.uint16(1)
        table = pa.RecordBatch.from_arrays([near_dedup.binary_rows(np.stack([a, b])), pa.array([1, 2])], ["short", "cls"])
        keys = [np.asarray(batch.column("key")) for batch in near_dedup._keys([table])]
        assert any(x == y for x, y in keys)


# Decontamination ---------------------------------------------------------------


def test_contamination_equals_brute_force(spark, documents):
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    pairs = [(str(i), t) for i, t in zip(items.item_id, items.text)]
    got = queries.op3_decontamination(spark, SF_DIR).toPandas().set_index("doc_id")
    assert got.contaminated.any() and len(got) == len(documents)
    for i, t in zip(documents.doc_id, documents.text):
        hit, found = brute.contamination(t, pairs)
        row = got.loc[i]
        assert (row.n_words, row.n_hit, row.n_items) == (len(brute.alnum_words(t)), len(hit), len(found))
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 22, 200])
def test_contamination_by_short_items_in_blocks(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items = [(1, "a"), (2, "B c"), (3, None), (4, ""), (None, "q r s"), (5, "a b c d e f g h i j k"), (6, "a b c d e f g h i j"), (6, "t u")]
    docs = [(1, "x A y"), (2, "b, c b"), (3, "q-r-s a"), (4, "0 a b c d e f g h i j k 0"), (5, None), (6, ""), (7, "t u b c"), (8, "a b c d e f g h i")]
    got = decontaminate.find_contamination(
        spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = [("" if i is None else str(i), t) for i, t in items if t is not None]
    for row in got:
        hit, found = brute.contamination(row["text"], pairs)
        assert {k for h in row["hits"] for k in range(h["first"], h["last"] + 1)} == hit, row
        assert row["items"] == sorted(found)


def test_many_blocks_are_one_python_stage(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    items = [(k, f"item {k} says that {k * 7919} is not {k * 104729} at all") for k in range(40)]
    docs = spark.createDataFrame([(k, f"so {items[k][1]} and {items[39 - k][1]}") for k in range(40)], DOCS)
    got = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["items"] for r in got.collect()} == {k: sorted({str(k), str(39 - k)}) for k in range(40)}


def test_contamination_of_odd_texts(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_contamination(odd_docs, none)
    assert got.count() == len(ODD_TEXTS) and got.filter("size(hits) > 0").count() == 0
    one = spark.createDataFrame([(1, "five six")], "item_id long, text string")
    assert decontaminate.find_contamination(odd_docs, one).filter("size(hits) > 0").count() == 4
    assert decontaminate.find_contamination(no_docs, one).count() == 0


# Licences ----------------------------------------------------------------------


def test_phrases_equal_brute_force(spark, documents):
    got = queries.op5_license_scan(spark, SF_DIR).toPandas().set_index("doc_id")
    assert len(got) == len(documents) and (got.n_base > 0).any()
    for i, t in zip(documents.doc_id, documents.text):
        places = brute.phrase_places(t, license_scan.PHRASES)
        row = got.loc[i]
        assert (row.n_words, row.n_base) == (len(brute.alnum_words(t)), len(places))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        if places:
            assert (row.first_word, row.last_word) == (places[0][0], places[-1][0])


@pytest.mark.parametrize("templates", [{}, license_scan.TEMPLATES])
def test_phrases_of_one_word(spark, templates):
    phrases = {"gplv3": "gpl", "license": "any", "mit license": "mit", "a b": "ab"}
    docs = [(1, "GPLv3"), (2, "gplv3 gplv3, x"), (3, "x the MIT license gplv3"), (4, "mit"), (5, "license"), (6, "b"), (7, "a license b gplv3 a b"), (8, None)]
    for used in (phrases, {"gplv3": "gpl"}):
        got = license_scan.scan_licenses(spark.createDataFrame(docs, DOCS).coalesce(1), used, templates).collect()
        assert len(got) == len(docs)
        for r in got:
            assert [(p["first"], p["label"]) for p in r["phrases"]] == brute.phrase_places(r["text"], used), r
    assert license_scan.scan_licenses(spark.createDataFrame(docs, DOCS), {}, {}).filter("size(phrases) > 0").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.lists(st.sampled_from("abc"), min_size=2, max_size=6), min_size=1, max_size=4))
def test_matching_statistics(words, templates):
    auto = license_scan.LicenseAutomaton({}, {str(k): " ".join(t) for k, t in enumerate(templates)})
    hashes = [text.hash_word(w) for w in words]
    known = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for k, (state, length) in enumerate(auto.follow(hashes)):
        want = max((n for n in range(k + 2) if n == 0 or tuple(words[k + 1 - n : k + 1]) in known))
        assert length == want
        if length:
            run = words[k + 1 - length : k + 1]
            assert auto.states[state].ends == [(n, j) for n, t in enumerate(templates) for j in range(len(t)) if t[max(0, j - length + 1) : j + 1] == run]


def test_templates_with_changed_words(spark):
    mit = license_scan.TEMPLATES["mit"].split()
    changed = mit[:15] + ["nor", "other"] + mit[16:]
    docs = [(1, "x y " + " ".join(mit) + " z"), (2, " ".join(changed).upper()), (3, " ".join(mit[:20])), (4, "under the MIT-license, cc by nc cc by nc"),
            (5, license_scan.TEMPLATES["apache-2"])]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(docs, DOCS)).collect()}
    assert [(s["label"], s["first"], s["cover"]) for s in got[1]["spans"]] == [("mit", 2, 1.0)]
    assert [s["label"] for s in got[2]["spans"]] == ["mit"] and got[2]["spans"][0]["cover"] < 1
    assert got[3]["spans"] == []
    assert [(p["label"], p["first"]) for p in got[4]["phrases"]] == [("mit", 0), ("cc-by-nc", 4), ("cc-by-nc", 7)]
    assert [p["label"] for p in got[5]["phrases"]] == ["apache-2"] and [s["label"] for s in got[5]["spans"]] == ["apache-2"]


def test_every_copy_of_a_licence_has_a_span(spark):
    mit, mpl = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["mpl-2"].split()
    first, second = [*mpl[:12], "x", *mpl[13:]], [*mpl[:4], "y", *mpl[5:]]
    docs = [(1, f"{mit} {mit}"), (2, f"a {mit} b " + "c " * 100 + f"{mit}\n{mit}"), (3, " ".join(first + second)),
            (4, " ".join(mpl[:8] + ["x"] + mpl[8:])), (5, " ".join(mpl[:8]) + " z " * 30 + " ".join(mpl[8:]))]
    got = {r["doc_id"]: r["spans"] for r in license_scan.scan_licenses(spark.createDataFrame(docs, DOCS)).collect()}
    n, m = len(mit.split()), len(mpl)
    assert [(s["label"], s["first"], s["last"], s["cover"]) for s in got[1]] == [("mit", 0, n - 1, 1.0), ("mit", n, 2 * n - 1, 1.0)]
    assert [(s["first"], s["last"]) for s in got[2]] == [(1, n), (n + 102, 2 * n + 101), (2 * n + 102, 3 * n + 101)]
    assert [(s["label"], s["first"] < m, s["last"] < m) for s in got[3]] == [("mpl-2", True, True), ("mpl-2", False, False)]
    assert [(s["first"], s["last"], s["cover"]) for s in got[4]] == [(0, m, 1.0)] and got[5] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 5), st.integers(0, 7)), min_size=1, max_size=6), st.integers(0, 4))
def test_chains_cover_most(runs, gap):
    """Against all chains of all subsets of runs."""
    runs = sorted(set(runs))
    single: dict[tuple[int, int], int] = {}

    def grow(begin, last, last_place, covered, rest):
        single[begin, last] = max(single.get((begin, last), 0), covered)
        for k, (first, length, place) in enumerate(rest):
            if last < first + length - 1 and first - last - 1 <= gap and last_place < place + length - 1:
                fresh = min(length, place + length - 1 - last_place, first + length - 1 - last)
                grow(begin, first + length - 1, place + length - 1, covered + fresh, rest[k + 1 :])

    for k, (first, length, place) in enumerate(runs):
        grow(first, first + length - 1, place + length - 1, length, runs[k + 1 :])
    enough = sorted((b, e, c) for (b, e), c in single.items() if c >= 0.5 * 12)

    def most(after):
        return max([(0, 0, 0)] + [(c + t, n - 1, w - (e - b + 1)) for b, e, c in enough if b > after for t, n, w in [most(e)]])

    got = license_scan._chains(runs, gap, 12, 0.5)
    assert all(x[2] < y[1] for x, y in zip(got, got[1:])) and all(c >= 6 for c, _, _ in got)
    assert (sum(c for c, _, _ in got), -len(got), -sum(e - b + 1 for _, b, e in got)) == most(-1)


def test_licences_of_odd_texts(odd_docs, no_docs):
    got = license_scan.scan_licenses(odd_docs)
    assert got.count() == len(ODD_TEXTS) and got.filter("size(phrases) + size(spans) > 0").count() == 0
    assert license_scan.scan_licenses(no_docs).count() == 0


# Pieces ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    with open(queries.piece_model(), "rb") as file:
        return piece_encoding.PieceEncoder(file.read())


def test_pieces_equal_the_library(spark, documents, encoder):
    got = queries.op9_piece_encoding(spark, SF_DIR).toPandas().set_index("doc_id")
    for i, t in zip(documents.doc_id, documents.text):
        ids = encoder.library.encode(t, add_bos=True, add_eos=True)
        assert got.n_tokens[i] == len(ids)
        assert got.ids_sha256[i] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got.decoded_sha256[i] == hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁aeths.,I"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_has_the_librarys_pieces(encoder, t):
    packed = encoder.encode(t)
    assert np.frombuffer(packed, "<u4").tolist() == encoder.library.encode(t)


def test_every_new_chunk_is_compared(monkeypatch, encoder):
    monkeypatch.setattr(encoder, "kept", {})
    monkeypatch.setattr(encoder, "_heap_ids", lambda chunk: b"\1\0\0\0")
    long = [f"▁{'word' * 10}{k}" for k in range(20)]
    for chunk in ["\n", *long]:
        with pytest.raises(ValueError):
            encoder.keep({chunk})


def test_the_compared_text_is_not_the_shortest(monkeypatch, encoder):
    compared = []
    monkeypatch.setattr(piece_encoding, "encoder_of", lambda model: encoder)
    monkeypatch.setattr(encoder, "compare", lambda t, packed: compared.append(t))
    model = type("Sent", (), {"value": b""})
    batches = [pa.RecordBatch.from_pydict({"text": [f"a{k}", f"one longer text {k}", None, ""]}) for k in range(30)]
    assert len(list(piece_encoding._encode(model, True, True, False)(iter(batches)))) == len(compared) == 30
    assert {len(t) < 5 for t in compared} == {True, False}


def test_pieces_of_odd_texts(odd_docs, no_docs):
    model = queries.piece_model()
    got = piece_encoding.decode_pieces(piece_encoding.encode_pieces(odd_docs, model), model).collect()
    assert len(got) == len(ODD_TEXTS)
    assert all(r["decoded"].replace(" ", "") == (r["text"] or "").replace(" ", "") for r in got)
    assert piece_encoding.encode_pieces(no_docs, model, decode=True).count() == 0


# Repeated lines ----------------------------------------------------------------


def _stretches_of(pieces: list[tuple[str, bool]]) -> list[tuple[int, int, int]]:
    """Begin, end and words of the stretches that go."""
    out, at = [], 0
    for piece, gone in pieces:
        if gone and out and out[-1][1] == at:
            out[-1] = (out[-1][0], at + len(piece), out[-1][2] + len(piece.split()))
        elif gone:
            out.append((at, at + len(piece), len(piece.split())))
        at += len(piece)
    return out


def test_repeats_equal_brute_force(spark, documents):
    got = queries.op10_substring_dedup(spark, SF_DIR).toPandas().set_index("doc_id")
    want = brute.without_repeats(list(zip(documents.doc_id, documents.text)))
    assert (got.n_removed > 0).any() and (got.n_passages > 0).any()
    for i, pieces in want.items():
        lost, row = _stretches_of(pieces), got.loc[i]
        assert row.text == brute.kept_text(pieces) and row.removed == ",".join(f"{a}-{b}" for a, b, _ in lost)
        assert (row.n_units, row.n_removed) == (len(pieces), sum(gone for _, gone in pieces))
        assert (row.longest_removed, row.n_passages) == (max((n for *_, n in lost), default=0), sum(n >= 25 for *_, n in lost))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB.!? \t\n\r\u00a0", max_size=40))
def test_pieces_hold_every_character(t):
    got = [[t[a:b] for a, b in line] for line in substring_dedup.pieces_of(t)]
    assert got == brute.pieces(t) and "".join(p for line in got for p in line) == t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b.", "c. ", "d e f g h! ", "\n", "i", " ", "j k l? ", "A B. "]), max_size=14).map("".join), min_size=1, max_size=5))
def test_repeats_of_short_sentences(texts):
    """The operator's units and what is cut, without Spark's part."""
    places: dict[tuple, tuple] = {}
    for i, t in enumerate(texts):
        for place, _, _, words in substring_dedup.hashed_units(t):
            places.setdefault(tuple(words), (i, place))
    for i, pieces in brute.without_repeats(list(enumerate(texts))).items():
        t = texts[i]
        spans = [{"start": a, "stop": b} for place, a, b, w in substring_dedup.hashed_units(t) if min(places[tuple(w)], (i, place)) < (i, place)]
        lost, n = substring_dedup._lost([p for line in substring_dedup.pieces_of(t) for p in line], spans)
        assert lost == [(a, b) for a, b, _ in _stretches_of(pieces)] and n == sum(gone for _, gone in pieces)


def _prose(rng, n: int) -> list[str]:
    words = [f"w{rng.integers(0, 3000)}" for _ in range(n)]
    for k in range(int(rng.integers(4, 12)), n, int(rng.integers(6, 14))):
        words[k] += rng.choice([".", "!", ".\n", "?"])
    return words


def test_planted_passages_go(spark):
    """Passages of over 50 words, some inside lines, some in short lines, among other words."""
    rng = np.random.default_rng(11)
    passages = [" ".join(_prose(rng, int(rng.integers(60, 120)))) for _ in range(10)]
    passages += ["\n".join(f"verse {k} {rng.integers(0, 9999)}" for k in range(25)) + "\n" for _ in range(3)]
    docs, planted = [], {}
    for i in range(200):
        words = _prose(rng, 80)
        if i % 4 == 0:
            planted[i] = passages[(i // 4) % len(passages)]
            words.insert(int(rng.integers(0, 80)), planted[i])
        docs.append((i, " ".join(words)))
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(spark.createDataFrame(docs, DOCS)).collect()}
    later = [i for k, i in enumerate(planted) if k >= len(passages)]
    for i in later:
        size = len(planted[i].split())
        assert got[i]["longest_removed"] >= size - 30 and got[i]["n_passages"] == 1, i
    clean = [i for i in got if i not in planted]
    assert all(got[i]["n_passages"] == 0 and got[i]["text"] == dict(docs)[i] for i in clean)


def test_paragraphs_and_ties(spark):
    docs = [(2, "a b c d e\n\nshort\n\n\nA  b C d e"), (1, "x y z u v w\n\na b c d e"), (3, "a b c d e"), (3, "a b c d e"), (4, None), (None, "a b c d e")]
    got = substring_dedup.remove_repeats(spark.createDataFrame(docs, DOCS), "paragraph").collect()
    kept = sorted((str(r["doc_id"]), r["text"]) for r in got)
    assert kept == [("1", "x y z u v w\n\n"), ("2", "short\n\n\n"), ("3", ""), ("3", ""), ("4", None), ("None", "a b c d e")]


def test_short_lines_and_short_sentences(spark):
    docs = spark.createDataFrame([(1, "Yes. No way at all. Yes.\nmenu\n"), (2, "menu\nWell. No way at all. Yes.\nYes.")], DOCS)
    kept = lambda unit: [r["text"] for r in substring_dedup.remove_repeats(docs, unit).orderBy("doc_id").collect()]
    assert kept("sentence") == ["Yes. No way at all. Yes.\nmenu\n", "Well. Yes."]
    assert kept("line") == ["Yes. No way at all. Yes.\nmenu\n", "Well. No way at all. Yes.\nYes."]


def test_repeats_of_odd_texts(spark, odd_docs, no_docs):
    got = substring_dedup.remove_repeats(odd_docs.withColumn("n_passages", odd_docs.hits)).collect()
    assert len(got) == len(ODD_TEXTS)
    assert {r["doc_id"]: r["text"] for r in got}[11] == "word " * 30_000
    assert substring_dedup.remove_repeats(no_docs).count() == 0


# Language ----------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id")
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert all(got.held_out[i] == brute.held_out(i) for i in docs.index)
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang[held.index]).mean() > 0.97


def test_languages_equal_brute_force(spark, documents):
    """With room for all words and n-grams."""
    learned = [(int(i), t, g) for i, t, g in zip(documents.doc_id, documents.text, documents.lang) if not brute.held_out(i) and t is not None and g is not None]
    twin = brute.Languages([(t, g) for _, t, g in learned])
    model = language_id.fit_language_model(spark.createDataFrame(learned, DOCS + ", lang string"), max_words=10**6, max_grams=10**6)
    assert [len(model.words.keys)] + [len(model.grams[k].keys) for k in range(1, 6)] == [len(twin.known[k]) for k in range(6)]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    for row in language_id.identify_languages(docs, model).collect():
        name, score = twin.predict(row["text"])
        assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-6, row


def test_unknown_words_fall_back_as_in_brute_force(spark):
    rows = [(k, t, g) for k, (t, g) in enumerate([("house hill mouse house", "en"), ("haus hügel maus", "de"), ("maison colline", "fr")])]
    model = language_id.fit_language_model(spark.createDataFrame(rows, DOCS + ", lang string"))
    twin = brute.Languages([(t, g) for _, t, g in rows])
    texts = ["house", "houses", "hous", "hx", "aus", "Ü", "qqq", "мир", "maisonette haus hill", "a", "mous colli ü zz", "s"]
    got = language_id.identify_languages(spark.createDataFrame(list(enumerate(texts)), DOCS), model).collect()
    for row in got:
        name, score = twin.predict(row["text"])
        assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-9, row


def test_a_small_language_keeps_its_words(spark):
    """The room for words is dealt to the languages, not to the most frequent words of all."""
    rows = [(k, "alpha beta gamma delta " * 50, "big") for k in range(30)] + [(99, "omega omega omega psi", "small")]
    model = language_id.fit_language_model(spark.createDataFrame(rows, DOCS + ", lang string"), max_words=4, max_grams=8)
    assert len(model.words.keys) == 4
    got = language_id.identify_languages(spark.createDataFrame([(1, "psi omega"), (2, "beta")], DOCS), model).collect()
    assert len({r["lang_pred"] for r in got}) == 2 and {r["lang_pred"] for r in got if r["doc_id"] == 1} == {"small"}


def test_languages_of_odd_texts(spark, odd_docs, no_docs):
    rows = [(k, t, lang) for k in range(20) for t, lang in (("the house is on the hill", "en"), ("das haus ist auf dem berg", "de"))]
    rows += [(99, "x", None), (98, None, "en")]
    model = language_id.fit_language_model(spark.createDataFrame(rows, DOCS + ", lang string"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify_languages(odd_docs, model).collect()}
    assert got[1] == got[2] == got[3] == got[13] == ("und", 0.0) and got[10][0] in ("de", "en")
    assert language_id.identify_languages(no_docs, model).count() == 0
    more = spark.createDataFrame([(1, "the hillside"), (2, "Bergauf HAUS"), (3, "★ 12 —"), (4, "Ж")], DOCS)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify_languages(more, model).collect()}
    assert (got[1], got[2], got[3]) == ("en", "de", "und") and got[4] != "und"
    nothing = language_id.fit_language_model(spark.createDataFrame([], DOCS + ", lang string"))
    assert {r["lang_pred"] for r in language_id.identify_languages(odd_docs, nothing).collect()} == {"und"}


# Toxicity ----------------------------------------------------------------------


def test_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    labels = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id")
    got = queries.op1_toxicity(spark, folder).toPandas().set_index("doc_id")
    own = got.loc[labels.index]
    assert (own.toxic == (labels.toxic == 1)).mean() > 0.99
    assert got.severity.between(0, 3).all() and own[labels.toxic == 1].grade.nunique() > 1


def test_severity_equals_brute_force(spark, documents):
    """Words, grades and scores by plain rules; the weights are a maximum of the likelihood."""
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    flag_of = {i: f > 0 for i, f in zip(labels.doc_id, labels.toxic) if not pd.isna(f)}
    known = [(t, flag_of[i]) for i, t in zip(docs.doc_id, docs.text) if i in flag_of]
    chosen = brute.telling_words(known)
    frames = [spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels")]
    model = toxicity.fit_toxicity(*frames)
    assert set(model.words.tolist()) == {hash_word(w) for w in chosen}
    place = {h: k for k, h in enumerate(model.words.tolist())}
    weights = {w: float(model.weights[place[hash_word(w)]]) for w in chosen}
    cuts = model.thresholds.tolist()
    for row in toxicity.score_toxicity(frames[0], model).collect():
        chances = brute.grade_chances(weights, cuts, row["text"])
        assert abs(row["severity"] - sum(j * p for j, p in enumerate(chances))) < 1e-6
        assert chances[row["grade"]] > max(chances) - 1e-9 and abs(row["p_toxic"] - sum(chances[1:])) < 1e-6

    strength = [sum(chosen.get(w, False) for w in brute.alnum_words(t)) for t, _ in known]
    terciles = np.quantile([s for s, (_, flag) in zip(strength, known) if flag], [1 / 3, 2 / 3])
    grades = [1 + int((s > terciles).sum()) if flag else 0 for s, (_, flag) in zip(strength, known)]
    grades = np.unique(grades, return_inverse=True)[1]
    assert len(cuts) == grades.max() and cuts == sorted(cuts)

    def loss(own_weights, own_cuts):
        likely = [np.log(max(brute.grade_chances(own_weights, own_cuts, t)[g], 1e-12)) for (t, _), g in zip(known, grades)]
        return -np.mean(likely) + toxicity.PENALTY / 2 * sum(w * w for w in own_weights.values())

    least = loss(weights, cuts)
    strongest = sorted(weights, key=lambda w: -abs(weights[w]))[:2]
    for step in (-0.5, 0.5):
        assert all(loss(weights | {w: weights[w] + step}, cuts) > least - 1e-4 for w in strongest)
        assert loss(weights, [c + step for c in cuts]) > least - 1e-4


def test_thresholds_are_ordered_and_shared():
    rng = np.random.default_rng(3)
    x = rng.poisson(1.0, (3000, 2)).astype(float)
    latent = 1.5 * x[:, 0] + rng.logistic(size=3000)
    grades = np.searchsorted([0.5, 2.0, 3.5], latent)
    row, column = np.nonzero(np.ones_like(x))
    weights, cuts = toxicity.fit_thresholds(row, column, x[row, column], grades, np.ones(3000), 2)
    assert np.allclose(weights, [1.5, 0.0], atol=0.2) and np.allclose(cuts, [0.5, 2.0, 3.5], atol=0.3)


def test_toxicity_of_odd_input(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd_docs, none)
    got = toxicity.score_toxicity(odd_docs, model).collect()
    assert model is None and len(got) == len(ODD_TEXTS) and all(r["severity"] == 0 for r in got)
    rows = [(k, "you utter fool, fool" if k % 3 == 0 else "a fine day") for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(0, 1), (0, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).filter("p_toxic >= 0.5").count() == 20
    assert toxicity.score_toxicity(odd_docs, model).filter("p_toxic >= 0.5").count() == 0
    assert toxicity.score_toxicity(no_docs, model).count() == 0


