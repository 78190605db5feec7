"""The anchor catalog: an append-only table whose latest entry for a text counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.config import CONTRACT_VERSION

SCHEMA = (
    "text_id string, rung string, filling struct<kind: string, ref: string>, provenance struct<source_format: string, source_edition: string, translation_layer: string>, "
    "body_size int, gate struct<passed: boolean, contract_version: string>, body_hash string, freeze_key string, seq bigint"
)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path)


def current(log: DataFrame) -> DataFrame:
    """The last entry of each text_id: a maximum, combined before the shuffle."""
    rest = [c for c in log.columns if c not in ("text_id", "seq")]
    return log.groupBy("text_id").agg(F.max_by(F.struct(*rest), "seq").alias("_e"), F.max("seq").alias("seq")).select("text_id", "_e.*", "seq")


def entries(registered: DataFrame, seq: int, kind: str = "canonical", rung: str = "canonical") -> DataFrame:
    """Rows to append for documents that passed (raw_hash, provenance, body_size, body_hash, freeze_key)."""
    return registered.select(
        F.col("raw_hash").alias("text_id"), F.lit(rung).alias("rung"), F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("ref")).alias("filling"),
        "provenance", "body_size", F.struct(F.lit(True).alias("passed"), F.lit(CONTRACT_VERSION).alias("contract_version")).alias("gate"), "body_hash", "freeze_key", F.lit(seq).cast("bigint").alias("seq"),
    )


def register(log_path: str, rows: DataFrame) -> None:
    rows.write.mode("append").json(log_path)


def stats(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("rung").agg(F.count("*").alias("n"))


def stale(catalog: DataFrame, version: str = CONTRACT_VERSION) -> DataFrame:
    return catalog.where(F.col("gate.contract_version") != version).select("text_id")


def lookup(docs: DataFrame, catalog: DataFrame) -> DataFrame:
    """docs (raw_hash, ...) with entry (null: none), by raw hash alone."""
    rest = F.struct(*[c for c in catalog.columns if c != "text_id"]).alias("entry")
    return docs.join(catalog.select(F.col("text_id").alias("raw_hash"), rest), "raw_hash", "left")
