"""Cleaning: five stages over ordered lines, none of which touches a marker line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.config import NOISE_PATTERNS, PRECLEAN_VERSION, Config
from vellum.functions.text import WORD, WS, is_blank, is_sentinel, ltrim, rtrim, sha256, trim

from .frontmatter import NAVIGATION, with_labels
from .lines import by_doc, explode_lines, join_lines

PAGE_NUMBER = rf"^{WS}*[-–—]?{WS}*\p{{Nd}}{{1,4}}{WS}*[-–—]?{WS}*$"
TRAILING_HYPHEN = f"{WORD}-{WS}*$"
TERMINALS = ".!?:;”\")]…"


def java_pattern(pattern: str) -> str:
    """A noise pattern with Unicode classes, for Java."""
    return "(?U)" + pattern


def noise_patterns(config: Config) -> tuple[str, ...]:
    """The built-in patterns as one, so that a line is read once for all, and the extra ones as they are."""
    return (java_pattern("|".join(f"(?:{p})" for p in NOISE_PATTERNS)), *map(java_pattern, config.extra_noise))


def trim_front_matter(lines: DataFrame, config: Config, where: Column | None = None) -> DataFrame:
    """Drops navigation blocks at the start, in the documents where that is asked; a marker line ends the zone. Where something
    was dropped, blank lines are collapsed in the whole text, and leading ones go. The dropped lines of a document, front_zone
    at most, come back to its lines as one array, which needs no exchange."""
    so_far = by_doc().rowsBetween(Window.unboundedPreceding, 0)
    asked = F.lit(True) if where is None else where
    marked = lines.withColumn("_open", F.max(is_sentinel(F.col("line"))).over(so_far))
    blocks = marked.where(asked & ~F.col("_open") & ~is_blank(F.col("line")))
    blocks = blocks.select("doc_id", "line_no", trim(F.col("line")).alias("text"), (F.row_number().over(by_doc()) - 1).alias("idx"))
    labels = with_labels(blocks, config.min_run, config.front_zone).where(F.col("label") == NAVIGATION)
    flagged = lines.join(labels.groupBy("doc_id").agg(F.collect_list("line_no").alias("_gone")), "doc_id", "left").withColumn("_any", F.col("_gone").isNotNull())
    flagged = flagged.where(~F.coalesce(F.array_contains("_gone", F.col("line_no")), F.lit(False))).withColumn("_blank", is_blank(F.col("line")))
    kept = flagged.withColumn("_before", F.lag("_blank").over(by_doc())).withColumn("_lead", F.min("_blank").over(so_far))
    gone = F.col("_any") & F.col("_blank") & (F.coalesce("_before", F.lit(False)) | F.col("_lead"))
    return kept.where(~gone).select("doc_id", "line_no", "line")


def strip_noise(lines: DataFrame, config: Config) -> DataFrame:
    """Drops lines in which any pattern is found."""
    hit = F.lit(False)
    for p in noise_patterns(config):
        hit = hit | F.col("line").rlike(p)
    return lines.where(is_sentinel(F.col("line")) | ~hit)


def remove_page_numbers(lines: DataFrame) -> DataFrame:
    return lines.where(is_sentinel(F.col("line")) | ~F.col("line").rlike(PAGE_NUMBER))


def _islands(lines: DataFrame, joins_previous, piece, separator: str) -> DataFrame:
    """Lines merged into the first of each island; pieces are joined in order."""
    out = lines.withColumn("_joins", F.coalesce(joins_previous, F.lit(False)))
    out = out.withColumn("_island", F.sum((~F.col("_joins")).cast("int")).over(by_doc().rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("_continued", F.coalesce(F.lead("_joins").over(by_doc()), F.lit(False)))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("piece")))), lambda x: x["piece"])
    return out.groupBy("doc_id", "_island").agg(F.min("line_no").alias("line_no"), F.array_join(pieces, separator).alias("line")).drop("_island")


def dehyphenate(lines: DataFrame) -> DataFrame:
    """Joins a line that ends in a word and a hyphen with the next, on and on; a lone hyphen carries on what it follows."""
    line = F.col("line")
    own = ~is_sentinel(line) & line.rlike(TRAILING_HYPHEN)
    out = lines.withColumn("_flag", F.last(F.when(trim(line) != "-", own), True).over(by_doc().rowsBetween(Window.unboundedPreceding, 0)))
    joins = F.lag("_flag").over(by_doc()) & ~is_blank(line) & ~is_sentinel(line)
    piece = F.when(F.col("_joins"), ltrim(line)).otherwise(line)
    piece = F.when(F.col("_continued"), F.regexp_replace(piece, f"-{WS}*$", "")).otherwise(piece)
    return _islands(out, joins, piece, "")


def reflow(lines: DataFrame) -> DataFrame:
    """Joins a line that starts in lower case to the one before, if that doesn't end a sentence."""
    line = F.col("line")
    solid = ~is_sentinel(line) & ~is_blank(line)
    open_end = solid & ~F.substring(rtrim(line), -1, 1).isin(*TERMINALS)
    out = lines.withColumn("_open", open_end)
    joins = F.lag("_open").over(by_doc()) & solid & trim(line).rlike(r"^\p{IsLowercase}")
    piece = F.when(F.col("_joins"), trim(line)).when(F.col("_continued"), rtrim(line)).otherwise(line)
    return _islands(out, joins, piece, " ")


def clean_lines(lines: DataFrame, config: Config, trim_front: bool | Column = False) -> DataFrame:
    """All stages; trim_front may be a condition on the lines' columns."""
    if trim_front is not False:
        lines = trim_front_matter(lines, config, None if trim_front is True else trim_front)
    return reflow(dehyphenate(remove_page_numbers(strip_noise(lines, config))))


def preclean(docs: DataFrame, config: Config | None = None, text_col: str = "text", trim_front: bool = False) -> DataFrame:
    """(doc_id, body, preclean_version, output_sha256) of each text. A text of which every line goes has an empty body."""
    body = join_lines(clean_lines(explode_lines(docs, text_col), config or Config(), trim_front))
    out = docs.select("doc_id").join(body, "doc_id", "left").withColumn("body", F.coalesce("body", F.lit("")))
    return out.select("doc_id", "body", F.lit(PRECLEAN_VERSION).alias("preclean_version"), sha256(F.col("body")).alias("output_sha256"))
