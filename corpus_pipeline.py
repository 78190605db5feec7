"""The training-data pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import common, decontaminate, langid, pieces, simhash, suffix_dedup


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go."""
    common.small_batches(spark)
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    common.small_batches(spark)
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every byte that a repeated 200-byte string covers; n_chars follows."""
    common.small_batches(spark)
    out = suffix_dedup.remove_repeats(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    common.small_batches(spark)
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's piece ids, the scores of its four best segmentations, and its round trip."""
    common.small_batches(spark)
    out = pieces.encoded_digests(docs, carry=["doc_id"])
    return out.select("row.doc_id", "n_pieces", "ids_sha256", "scores", "decoded_bytes", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", tokens),
]
ORACLE_SQL = None  # learnt models and alignment are beyond SQL; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.cut(docs, name)
    return docs
