"""Files of any supported format as rows: one scan, dispatched by suffix; what can't be read is a reject, not a failure."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.config import FORMATS
from vellum.operators import catalog
from vellum.operators.pdf import CASE_SCHEMA, PATTERN_SCHEMA, seed_patterns

from .epub import epub_text
from .html import html_text
from .pdf import _file, layer_text, look_in, page_count, recognized


def format_of(path: Column, override: str | None = None) -> Column:
    """The format by suffix, txt by default; an override wins."""
    if override:
        return F.lit(override)
    suffix = F.regexp_extract(F.lower(path), r"(\.[^./]*)$", 1)
    table = F.create_map(*[x for k, v in FORMATS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(table[suffix], F.lit("txt"))


def plain_text(data: bytes) -> str:
    """Strict UTF-8, all line ends as line feeds."""
    return data.decode("utf-8").replace("\r\n", "\n").replace("\r", "\n")


def _pdf(data: bytes) -> str | int:
    """The layer's text, or the number of pages to recognise."""
    with _file(data) as path:
        text = layer_text(path)
        return page_count(path) if text is None else text


_READERS = {"txt": plain_text, "html": lambda b: html_text(b.decode("utf-8", "replace")), "epub": epub_text, "pdf": _pdf}


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def read_files(spark: SparkSession, path: str, source_edition: str = "unknown", translation_layer: str | None = None, source_format: str | None = None, without: DataFrame | None = None) -> DataFrame:
    """(doc_id: the path, text, source_format, source_edition, translation_layer, error). Unsupported suffixes and
    unreadable files have an error and no text. Files in without (doc_id) aren't opened."""
    raw = binary_files(spark, path)
    if without is not None:
        raw = raw.join(without.select(F.col("doc_id").alias("path")), "path", "left_anti")
    suffix = F.regexp_extract(F.lower("path"), r"(\.[^./]*)$", 1)
    known = F.col("path").rlike("(?i)/[^./]+$") | suffix.isin(*[s for s in FORMATS if s])
    raw = raw.withColumn("source_format", format_of(F.col("path"), source_format)).withColumn("reader", F.when(known, format_of(F.col("path"))))

    programs = os.environ.get("PATH", "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look_in(programs)
        for batch in batches:
            texts, errors, pages = [], [], []
            for kind, data in zip(batch["reader"], batch["content"], strict=True):
                found, error = None, None if kind else "unsupported format"
                try:
                    found = _READERS[kind](bytes(data)) if kind else None
                except Exception as e:  # noqa: BLE001  one bad file must not end the job
                    error = f"{type(e).__name__}: {e}"[:500]
                pages.append(found if isinstance(found, int) else None)
                texts.append(found if isinstance(found, str) else None)
                errors.append(error)
            yield pd.DataFrame({"doc_id": batch["path"], "text": texts, "source_format": batch["source_format"], "error": errors, "pages": pd.array(pages, dtype="Int32")})

    kind = "doc_id string, text string, source_format string, error string, pages int"
    out = raw.mapInPandas(read, kind).where("pages is null").drop("pages")
    pdf = raw.where("reader = 'pdf'")  # only these are looked at again for what to recognise
    scans = pdf.mapInPandas(read, kind).where("pages is not null").select(F.col("doc_id").alias("path"), "source_format", "pages")
    seen = recognized(pdf.select("path", "content").join(scans, "path")).join(scans, "path")
    out = out.unionByName(seen.select(F.col("path").alias("doc_id"), "text", "source_format", "error"))
    return out.select("doc_id", "text", "source_format", F.lit(source_edition).alias("source_edition"), F.lit(translation_layer).cast("string").alias("translation_layer"), "error")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line, blank lines skipped; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The latest entries of a log; none, if it isn't there yet."""
    return catalog.current(catalog.read(spark, path) if exists(spark, path) else catalog.empty(spark))


def read_memory(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(patterns, case log) of a memory folder. Where none was saved, the seeds and no cases."""
    rows = lambda part, schema: spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/{part}") if exists(spark, f"{path}/{part}") else None
    patterns, cases = rows("patterns", PATTERN_SCHEMA), rows("cases", CASE_SCHEMA)
    return seed_patterns(spark) if patterns is None else patterns, spark.createDataFrame([], CASE_SCHEMA) if cases is None else cases


def save_memory(patterns: DataFrame, cases: DataFrame, path: str) -> None:
    """Patterns are written once; cases are appended. How often a pattern was applied follows from the cases."""
    if not exists(patterns.sparkSession, f"{path}/patterns"):
        patterns.coalesce(1).write.json(f"{path}/patterns")
    cases.write.mode("append").json(f"{path}/cases")
