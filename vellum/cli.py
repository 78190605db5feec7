"""Command line: `python -m vellum.cli run PATH -o OUT` and `python -m vellum.cli quality CHUNKS -o OUT --report REPORT`.

Exit codes: 0 good, 2 every document too small, 3 none passed the gate, 4 every PDF refused at admission.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.operators import pdf, quality
from vellum.plans import pipeline
from vellum.sources import files
from vellum.sources.pdf import read_pages


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vellum", description="Deterministic text canonicalisation on Spark")
    commands = p.add_subparsers(dest="command", required=True)
    r = commands.add_parser("run", help="canonicalise files")
    r.add_argument("input", help="a file, folder or glob of epub, html, txt and pdf files")
    r.add_argument("-o", "--out", default="out")
    r.add_argument("--min-size", type=int, default=1000)
    r.add_argument("--size-unit", default="words", choices=["words", "chars"])
    r.add_argument("--source-format", default=None)
    r.add_argument("--source-edition", default="unknown")
    r.add_argument("--translation-layer", default=None)
    r.add_argument("--noise-pattern", action="append", default=[], metavar="REGEX")
    r.add_argument("--keep-front-matter", action="store_true")
    r.add_argument("--skip-pdf-diagnosis", action="store_true")
    r.add_argument("--force-process", action="store_true")
    q = commands.add_parser("quality", help="score chunks in JSON lines")
    q.add_argument("input")
    q.add_argument("-o", "--out", required=True)
    q.add_argument("--report", required=True)
    return p


def admit(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """(diagnoses of the PDF files among the input, those refused), from their text layers, before anything is extracted. A file
    that can't be diagnosed goes on without."""
    raw = files.binary_files(spark, a.input)
    pages = pipeline.written(read_pages(raw.where(F.lower("path").endswith(".pdf")), pdf.MAX_PAGES), f"{a.out}/tables/pdf_pages")
    failed = pages.where("error is not null").select("doc_id", "error")
    failed.write.mode("overwrite").json(f"{a.out}/pdf_undiagnosed")
    good = pages.where("error is null")
    known = good.groupBy("doc_id").agg(F.max("total_pages").alias("total_pages"), F.max("raw_hash").alias("raw_hash"))
    diagnoses = pdf.diagnose(good.select("doc_id", "page_no", "text"), known.select("doc_id", "total_pages")).join(known.select("doc_id", "raw_hash"), "doc_id")
    diagnoses = pipeline.written(diagnoses, f"{a.out}/tables/pdf_diagnoses")
    diagnoses.write.mode("overwrite").json(f"{a.out}/pdf_diagnostics")
    return diagnoses, diagnoses.where("decision = 'abort'").select("doc_id")


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    config = Config(a.min_size, a.size_unit, tuple(a.noise_pattern), a.keep_front_matter)
    diagnoses = refused = None
    if not a.skip_pdf_diagnosis:
        diagnoses, refused = admit(spark, a)
    docs = files.read_files(spark, a.input, a.source_edition, a.translation_layer, a.source_format, None if a.force_process else refused)
    docs = pipeline.written(docs, f"{a.out}/tables/extracted")  # files are read, and pages recognised, once
    docs.where("error is not null").select("doc_id", "error").write.mode("overwrite").json(f"{a.out}/unreadable")
    docs = docs.where("error is null").drop("error")
    if diagnoses is not None and not a.force_process and docs.isEmpty() and not refused.isEmpty():
        return 4
    log = f"{a.out}/anchor_catalog"
    catalog = files.read_catalog(spark, log)
    seq = 1 + (catalog.agg(F.max("seq")).first()[0] or 0)
    results = pipeline.run(docs, config, catalog, seq=seq).write(a.out, log)
    if diagnoses is not None:
        patterns, _ = files.read_memory(spark, f"{a.out}/pdf_resolution_memory")
        done = diagnoses.join(results.bodies.select("doc_id"), "doc_id", "left_semi")  # what was processed is logged, nothing else
        files.save_memory(patterns, pdf.cases(done, pdf.match_patterns(done, patterns)), f"{a.out}/pdf_resolution_memory")
    status = {r["status"]: r["count"] for r in results.dispatched.groupBy("status").count().collect()}  # a row for each status
    print(results.summary(files.read_catalog(spark, log)).toJSON().first())
    if status and set(status) == {"too_small"}:
        return 2
    return 3 if status and not set(status) & set(pipeline.GOOD) else 0


def score(spark: SparkSession, a: argparse.Namespace) -> int:
    chunks = files.read_jsonl(spark, a.input, "chunk_id long, chapter_id string, text string, word_count long")
    records = quality.records(chunks)
    records.write.mode("overwrite").json(a.out)
    quality.report(records).write.mode("overwrite").json(a.report)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("vellum").getOrCreate()
    return (run if a.command == "run" else score)(spark, a)


if __name__ == "__main__":
    sys.exit(main())
