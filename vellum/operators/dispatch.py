"""The dispatch ladder as one status column: no document's failure stops the others.

too_small: under the size door, nothing else is computed. reused: the catalog knows the raw text and cleaning
gives its body again. drift: it gives another body. unsupported_rung: the entry's rung has no engine.
canonical: cleaned and passed the gate. config: a candidate engine's body passed. needs_hook: nothing did.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.config import ENGINE_VERSION, Config
from vellum.functions.text import bind, body_size, freeze_key, repertoire_hash, sha256

from . import catalog as cat
from . import gate
from .clean import clean_lines
from .lines import explode_lines

TRIMMED_FORMATS = ("epub", "html", "pdf")


def filling_hash(config: Config, trimmed: bool) -> str:
    import hashlib

    base = repertoire_hash(config.noise)
    return hashlib.sha256(f"{base}\x1f{config.front_matter_signature}".encode()).hexdigest() if trimmed else base


def prepare(docs: DataFrame, config: Config) -> DataFrame:
    """raw_hash, trimmed (front matter is cut: rich formats only), filling_hash and freeze_key of docs."""
    trimmed = F.lit(not config.keep_front_matter) & F.col("source_format").isin(*TRIMMED_FORMATS)
    out = docs.withColumn("raw_hash", sha256(F.col("text"))).withColumn("trimmed", F.coalesce(trimmed, F.lit(False)))
    out = out.withColumn("filling_hash", F.when(F.col("trimmed"), filling_hash(config, True)).otherwise(filling_hash(config, False)))
    return out.withColumn("freeze_key", freeze_key(F.col("raw_hash"), F.col("filling_hash"), ENGINE_VERSION))


def dispatch(docs: DataFrame, config: Config | None = None, catalog: DataFrame | None = None, candidates: Sequence[Callable[[DataFrame], DataFrame]] = ()) -> DataFrame:
    """docs (doc_id, text, source_format, source_edition, translation_layer) -> doc_id, raw_hash, status, body, body_hash,
    body_size, static_failure, roundtrip_failure, filling_hash, freeze_key, provenance. candidates map docs to (doc_id, body).
    Texts are cut into lines once; cleaning and gate go on with these lines, and only hashes of the texts are joined again."""
    config = config or Config()
    ready = prepare(docs, config).withColumn("_size", body_size(F.col("text"), config.unit))
    small = F.coalesce(F.col("_size") < config.min_size, F.lit(True))
    cleaned = clean_lines(explode_lines(ready.where(~small), "text", "trimmed"), config, F.col("trimmed"))
    known = _verdict(ready.where(~small).drop("text", "_size"), cleaned, config).withColumn("body_hash", sha256(F.col("body")))
    known = cat.lookup(known, cat.current(catalog)) if catalog is not None else known.withColumn("entry", F.lit(None).cast("struct<rung: string, body_hash: string>"))
    reuse = F.when(F.col("entry").isNotNull(), F.when(F.col("entry.rung") != "canonical", "unsupported_rung").when(F.col("entry.body_hash") != F.col("body_hash"), "drift").otherwise("reused"))
    out = known.withColumn("status", F.coalesce(reuse, F.when(F.coalesce("_static", "_round").isNull(), "canonical").otherwise("needs_hook")))
    for engine in candidates:
        left = docs.join(out.where("status = 'needs_hook'").select("doc_id"), "doc_id", "left_semi")
        tried = left.drop("text").join(engine(left).select("doc_id", F.col("body").alias("_other")), "doc_id")
        bodies = _verdict(tried, explode_lines(tried, "_other"), config).where("_static is null and _round is null").select("doc_id", "_other")
        out = out.join(bodies, "doc_id", "left").withColumn("body", F.coalesce("_other", "body")).withColumn("status", F.when(F.col("_other").isNotNull(), "config").otherwise(F.col("status")))
        out = out.withColumn("body_hash", sha256(F.col("body"))).drop("_other")
    columns = ["doc_id", "raw_hash", "status", "body", "body_hash", body_size(F.col("body"), config.unit).alias("body_size"), F.when(F.col("status") == "needs_hook", F.col("_static")).alias("static_failure"), F.when(F.col("status") == "needs_hook", F.col("_round")).alias("roundtrip_failure"), "filling_hash", "freeze_key", gate.provenance().alias("provenance")]
    done = out.select(*columns)
    none = F.lit(None).cast("string")
    return done.unionByName(ready.where(small).select("doc_id", "raw_hash", F.lit("too_small").alias("status"), none.alias("body"), none.alias("body_hash"), F.col("_size").alias("body_size"), none.alias("static_failure"), none.alias("roundtrip_failure"), "filling_hash", "freeze_key", gate.provenance().alias("provenance")))


def _verdict(docs: DataFrame, lines: DataFrame, config: Config) -> DataFrame:
    """docs with body and the first failure of either part of the gate (_static, _round)."""
    checked = gate.own_checks(docs, lines, config)
    first = lambda early: F.filter("checks", lambda c: ~c["passed"] & ((c["ord"] < 7) if early else (c["ord"] >= 7)))
    code = lambda failed: F.when(F.size(failed) > 0, failed[0]["code"])
    return checked.withColumn("_static", bind(first(True), code)).withColumn("_round", bind(first(False), code)).drop("checks")


def anchor(to_body: Callable[[str], str]) -> Callable[[DataFrame], DataFrame]:
    """A plug-in for text that the canonical route can't settle, as a candidate: an Arrow batch function; its bodies pass the gate like all others."""

    def run(docs: DataFrame) -> DataFrame:
        def bodies(batches):
            for batch in batches:
                yield pd.DataFrame({"doc_id": batch["doc_id"], "body": batch["text"].map(to_body)})

        return docs.select("doc_id", "text").mapInPandas(bodies, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, body string")

    return run
