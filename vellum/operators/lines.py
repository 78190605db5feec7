"""Texts as ordered lines with exact character offsets.

Lines are keyed by doc_id and line_no, which every later step keeps; all of a document's rows share one hash
partition, so windows and groups by doc_id need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def by_doc():
    """A document's lines in order."""
    return Window.partitionBy("doc_id").orderBy("line_no")


def explode_lines(df: DataFrame, text_col: str = "text", *carry: str) -> DataFrame:
    """(doc_id, line_no, line) of each text, empty lines included, with the columns to carry. A null text has no lines. Ids
    are unique and not null: lines of texts with one id can't be told apart."""
    return df.select("doc_id", *carry, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line")).repartition("doc_id")


def with_offsets(lines: DataFrame) -> DataFrame:
    """char_start and char_end of each line in its text."""
    start = F.coalesce(F.sum(F.length("line") + 1).over(by_doc().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    return lines.withColumn("char_start", start).withColumn("char_end", F.col("char_start") + F.length("line"))


def join_lines(lines: DataFrame, name: str = "body") -> DataFrame:
    """(doc_id, text) of ordered lines."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return lines.groupBy("doc_id").agg(F.array_join(ordered, "\n").alias(name))
