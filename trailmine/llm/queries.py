"""The corpus operators as queries over whole tables, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmine.llm import (
    decontaminate,
    exact_search,
    language_id,
    license_scan,
    near_dedup,
    periodic_runs,
    piece_encoding,
    quotations,
    sql,
    substring_dedup,
    suffix_dedup,
    toxicity,
    vector_codes,
    warc,
)
from trailmine.storage import materialise

Query = Callable[[SparkSession, str], DataFrame]

TOXIC_FROM = 0.5  # P(grade > 0) from which a document counts as toxic
TOP_K = 20
CRAWL_DATE = "2024-01-01T00:00:00Z"


def piece_model() -> str:
    """The place of the vocabulary; no part of this repository."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, from the flags in ``labels``."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "severity", "grade", "p_toxic", (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by two-word shingles."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with windows of ten words of benchmark items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = F.coalesce(F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1), F.lit(0))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.fit_language_model(docs.filter(~held))
    found = language_id.identify_languages(docs.select("doc_id", "text", held.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("phrases", lambda p: p["first"])
    base = F.transform("phrases", lambda p: p["label"])
    spans = F.transform("spans", lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    cover = F.array_max(F.transform("spans", lambda s: s["cover"]))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.concat(base, spans)).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(cover, F.lit(0.0))).alias("score"))


def op6_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every row whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", exact_search.whole_components("embedding", 64).alias("v"))
    return exact_search.top_k(vectors, vectors.filter("vec_id % 20 = 0"), TOP_K)


def op7_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations without quotations, in reply order."""
    linked = quotations.link_quotations(_table(spark, sf_dir, "conversations"))
    return quotations.reply_ordered(linked)


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derive_records(warc.responses_of_pages(_table(spark, sf_dir, "pages"), CRAWL_DATE))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_encoding.encode_pieces(docs, piece_model(), decode=True)
    return coded.select(
        "doc_id", (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines and sentences that an earlier place has."""
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat(s["start"], F.lit("-"), s["stop"]))
    return cut.select("doc_id", *substring_dedup.COUNTS, F.array_join(spans, ",").alias("removed"), "text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every vector."""
    coded = vector_codes.encode_vectors(_table(spark, sf_dir, "embeddings"))
    rows = materialise(coded.rows, "coded-vectors")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(vector_codes.GREATEST)).cast("long")
    labels = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    numbers = ",".join(str(x) for x in coded.codebooks.entries.ravel().tolist())
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 50-byte strings that a document of a smaller id has."""
    cut = suffix_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` of which about one in ten repeats a stretch of its words up to its end.

    The crc32 of the doc_id names these, and where the stretch begins and how long it is. A
    null doc_id names none; texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    docs = docs.withColumns({"__g": F.floor(h / 10), "__w": F.when(h % 10 == 0, words)})
    docs = docs.withColumn("__a", F.expr("__g % size(__w)"))
    docs = docs.withColumn("__p", F.expr("1 + (size(__w) - __a) div (3 + __g % 8)"))
    tail = F.expr("transform(__w, (w, i) -> if(i < __a, w, __w[int(__a + (i - __a) % __p)]))")
    planted = F.when(F.size("__w") > 0, F.array_join(tail, " ")).otherwise(F.col("text"))
    return docs.withColumn("text", planted).drop("__g", "__w", "__a", "__p")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of them planted."""
    docs = with_periodic_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs)
    best = F.array_max(F.expr("transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period))"))
    found = found.withColumn("best", best)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_decontamination": op3_decontamination,
        "op4_language_id": op4_language_id,
        "op5_license_scan": op5_license_scan,
        "op6_exact_search": op6_exact_search,
        "op7_quotations": op7_quotations,
        "op8_warc_derivatives": op8_warc_derivatives,
        "op9_piece_encoding": op9_piece_encoding,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_vector_codes": op11_vector_codes,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.QUERIES)
