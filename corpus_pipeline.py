"""From raw documents to pieces of clean ones, stage by stage.

Each stage works on all that its predecessor kept, written as Parquet to the shared folder
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmine.llm import decontaminate, near_dedup, piece_encoding, queries, substring_dedup, toxicity
from trailmine.storage import remove_path, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not take for toxic."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.filter(F.col("p_toxic") < queries.TOXIC_FROM).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle near copies, that of the smallest doc_id."""
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences and lines that an earlier document has; ``n_chars`` follows the text."""
    cut = substring_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("hits") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces and a digest of what these decode to."""
    coded = piece_encoding.encode_pieces(docs, queries.piece_model(), decode=True)
    return coded.select(
        *docs.columns, (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"), "token_bytes",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("piece_encoding", encode),
]

#: The ordinal model and the pieces have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's input and intermediate tables go when it is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
