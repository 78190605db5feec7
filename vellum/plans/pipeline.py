"""The whole run over a table of documents, as one lazy plan of named results, and its sinks."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.operators import catalog as cat
from vellum.operators import chunk, eligibility, quality, segment
from vellum.operators.dispatch import dispatch


#: Statuses of documents that have a body.
GOOD = ("canonical", "reused", "config")
RECORDS = ("structure", "classification", "chunks", "formal", "quality", "formal_quality", "eligibility", "rejects")


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table at path, read again: what comes after starts there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Results:
    """Lazy tables; write() makes them files."""

    config: Config
    seq: int
    raw: DataFrame
    dispatched: DataFrame
    bodies: DataFrame
    structure: DataFrame
    classification: DataFrame
    chunks: DataFrame
    formal: DataFrame
    quality: DataFrame
    formal_quality: DataFrame
    eligibility: DataFrame
    rejects: DataFrame
    catalog_entries: DataFrame

    def write(self, path: str, log: str | None = None) -> Results:
        """Parquet for texts, JSON lines for records, one report; appends to the catalog log. Each table that several sinks read is
        written once, under path/tables, and the rest goes on from there; the results returned read these tables."""
        r = of_dispatched(self.raw, written(self.dispatched, f"{path}/tables/dispatched"), self.config, self.seq)
        r = replace(r, **of_structure(written(r.structure, f"{path}/tables/structure"), self.config))
        shared = {name: written(getattr(r, name), f"{path}/tables/{name}") for name in ("classification", "chunks", "formal")}
        r = replace(r, **shared, **of_chunks(**shared))
        r = replace(r, **{name: written(getattr(r, name), f"{path}/tables/{name}") for name in ("quality", "formal_quality")})
        for name in ("raw", "bodies"):
            getattr(r, name).write.mode("overwrite").parquet(f"{path}/{name}")
        for name in RECORDS:
            getattr(r, name).write.mode("overwrite").json(f"{path}/{name}")
        quality.report(r.quality).write.mode("overwrite").json(f"{path}/quality_report")
        if log:
            cat.register(log, r.catalog_entries)
        return r

    def settled(self, path: str) -> Results:
        """With dispatch and paragraphs, which all else is made of, as tables under path: several sinks don't compute them again."""
        r = of_dispatched(self.raw, written(self.dispatched, f"{path}/dispatched"), self.config, self.seq)
        return replace(r, **of_structure(written(r.structure, f"{path}/structure"), self.config))

    def summary(self, catalog: DataFrame | None = None) -> DataFrame:
        """One row: documents by status, paragraphs by class, good chunks of both windows, and, given the catalog, its entries by
        rung. Each part is one aggregate of a few rows."""
        ok = lambda df: df.agg(F.count_if(F.col("quality.status") == "ok"))
        counts = lambda df, key, name: df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("value")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(name))
        out = counts(self.dispatched, "status", "documents").crossJoin(counts(self.classification, "block_class", "classes"))
        out = out.crossJoin(ok(self.quality).toDF("ok_chunks")).crossJoin(ok(self.formal_quality).toDF("ok_formal_chunks"))
        return out if catalog is None else out.crossJoin(counts(catalog, "rung", "catalog"))


def run(docs: DataFrame, config: Config | None = None, catalog: DataFrame | None = None, candidates=(), seq: int = 0) -> Results:
    """docs (doc_id, text, source_format, source_edition, translation_layer)."""
    config = config or Config()
    return of_dispatched(docs.select("doc_id", "text"), dispatch(docs, config, catalog, candidates), config, seq)


def of_dispatched(raw: DataFrame, dispatched: DataFrame, config: Config, seq: int) -> Results:
    good = dispatched.where(F.col("status").isin(*GOOD))
    rejects = dispatched.where(~F.col("status").isin(*GOOD)).drop("body")
    return Results(config, seq, raw, dispatched, good.select("doc_id", "body", "body_hash", "body_size"), **of_structure(segment.segment(good), config), rejects=rejects, catalog_entries=cat.entries(good.where("status != 'reused'"), seq))


def of_structure(structure: DataFrame, config: Config) -> dict[str, DataFrame]:
    classification = segment.classify(structure, config.min_run, config.front_zone)
    shared = {"classification": classification, "chunks": chunk.chunks(structure, config.target_chars, config.max_chars), "formal": chunk.formal(structure)}
    return {"structure": structure, **shared, **of_chunks(**shared)}


def of_chunks(classification: DataFrame, chunks: DataFrame, formal: DataFrame) -> dict[str, DataFrame]:
    tracks = eligibility.eligibility(chunks, classification, ("conceitual",)).unionByName(eligibility.eligibility(formal, classification, ("formal",)))
    return {"quality": quality.records(chunks), "formal_quality": quality.records(formal), "eligibility": tracks}
