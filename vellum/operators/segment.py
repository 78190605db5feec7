"""Paragraphs with exact spans and block types; structural classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.config import BQ_CLOSE, BQ_OPEN, FN_CLOSE, FN_OPEN, FRONT_ZONE, MIN_RUN, REF_OPEN
from vellum.functions.text import half_even, is_blank, strip_sentinels, trim

from .frontmatter import EDITORIAL, NAVIGATION, with_labels
from .lines import by_doc, explode_lines, with_offsets

MAIN_BODY, QUOTATION, FOOTNOTE = "main_body", "quotation_material", "footnote_material"
#: The order of reports.
CLASSES = (MAIN_BODY, QUOTATION, FOOTNOTE, EDITORIAL, NAVIGATION)


def with_depth(lines: DataFrame) -> DataFrame:
    """token, step (+1, -1, 0) and depth after each line, of a stack that ignores closers when empty: the running
    sum less its least value so far, or less zero."""
    so_far = by_doc().rowsBetween(Window.unboundedPreceding, 0)
    out = lines.withColumn("token", trim(F.col("line")))
    out = out.withColumn("step", F.when(F.col("token").isin(BQ_OPEN, FN_OPEN), 1).when(F.col("token").isin(BQ_CLOSE, FN_CLOSE), -1).otherwise(0))
    out = out.withColumn("_sum", F.sum("step").over(so_far))
    return out.withColumn("depth", (F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(so_far))).cast("int")).drop("_sum")


def segment(bodies: DataFrame, text_col: str = "body", chapter_id: str = "ch1") -> DataFrame:
    """(doc_id, para_idx, char_start, char_end, text, raw, block_type, chapter_id): each line that is neither blank nor a marker."""
    lines = with_depth(with_offsets(explode_lines(bodies, text_col)))
    kind = F.when(F.col("token") == BQ_OPEN, "blockquote").when(F.col("token") == FN_OPEN, "footnote")
    at_depth = Window.partitionBy("doc_id", "depth").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_kind", F.last(kind, True).over(at_depth))
    paragraphs = lines.where((F.col("step") == 0) & ~is_blank(F.col("line")))
    return paragraphs.select(
        "doc_id", (F.row_number().over(by_doc()) - 1).alias("para_idx"), "char_start", "char_end", strip_sentinels(F.col("line")).alias("text"), F.col("line").alias("raw"),
        F.when(F.col("depth") == 0, "body").otherwise(F.col("_kind")).alias("block_type"), F.lit(chapter_id).alias("chapter_id"),
    )


def classify(paragraphs: DataFrame, min_run: int = MIN_RUN, front_zone: int = FRONT_ZONE) -> DataFrame:
    """Classification records: quotes and notes by block type, the rest by front-matter regime, body by default."""
    is_body = F.col("block_type") == "body"
    order = Window.partitionBy("doc_id").orderBy("para_idx")
    every = paragraphs.withColumn("_body", is_body)
    every = every.withColumn("idx", F.when(is_body, F.row_number().over(Window.partitionBy("doc_id", "_body").orderBy("para_idx")) - 1)).drop("_body")
    labels = with_labels(every.where(is_body).select("doc_id", "idx", "text"), min_run, front_zone).select("doc_id", "idx", "label")
    out = every.join(labels, ["doc_id", "idx"], "left")
    block_class = (
        F.when(F.col("block_type") == "blockquote", QUOTATION).when(F.col("block_type") == "footnote", FOOTNOTE)
        .when(F.col("label") == NAVIGATION, NAVIGATION).when(F.col("label") == EDITORIAL, EDITORIAL).otherwise(MAIN_BODY)
    )
    total = F.count("*").over(Window.partitionBy("doc_id"))
    position = half_even((F.row_number().over(order) - 1) / total, 4)
    return out.select("doc_id", F.col("para_idx").alias("index"), "char_start", "char_end", "block_type", block_class.alias("block_class"), F.col("raw").contains(REF_OPEN).alias("has_note_call"), "chapter_id", position.alias("position"))


def class_counts(classification: DataFrame) -> DataFrame:
    return classification.groupBy("doc_id", "block_class").agg(F.count("*").alias("n"))
