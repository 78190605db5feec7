"""Chunk windows: a greedy fold over paragraph lengths, then plain grouping.

The fold can't be a window function, as a flush depends on what was flushed before. Only lengths go through it,
as one array of integers per document; texts stay in the JVM.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vellum.config import CONCEPTUAL, FORMAL


def greedy_ids(lengths: np.ndarray, target: int, most: int) -> np.ndarray:
    """The window of each paragraph: closed before one that would overflow it, and after one that fills it. A paragraph is never cut."""
    out = np.empty(len(lengths), np.int32)
    now, held, is_open = 0, 0, False
    for i, n in enumerate(lengths):
        if is_open and held + n > most:
            now, held = now + 1, 0
        out[i], held, is_open = now, held + n, True
        if held >= target:
            now, held, is_open = now + 1, 0, False
    return out


def _ids(target: int, most: int):
    @pandas_udf("array<int>")
    def ids(lengths: pd.Series) -> pd.Series:
        return lengths.map(lambda x: greedy_ids(x, target, most))

    return ids


def window_ids(paragraphs: DataFrame, target: int | None = None, most: int | None = None) -> DataFrame:
    """paragraphs with chunk_id. Missing or zero sizes are the conceptual ones."""
    target, most = target or CONCEPTUAL[0], most or CONCEPTUAL[1]
    ordered = F.array_sort(F.collect_list(F.struct("para_idx", F.length("text").alias("n"))))
    folded = paragraphs.groupBy("doc_id").agg(ordered.alias("_p")).withColumn("_ids", _ids(target, most)(F.transform("_p", lambda x: x["n"])))
    pairs = folded.select("doc_id", F.explode(F.arrays_zip(F.transform("_p", lambda x: x["para_idx"]).alias("para_idx"), F.col("_ids").alias("chunk_id"))).alias("x")).select("doc_id", "x.para_idx", "x.chunk_id")
    return paragraphs.join(pairs, ["doc_id", "para_idx"])


def _ratio(kind: str) -> Column:
    n = F.length("text")
    return F.coalesce(F.sum(F.when(F.col("block_type") == kind, n).otherwise(0)) / F.nullif(F.sum(n), F.lit(0)), F.lit(0.0))


def chunks(paragraphs: DataFrame, target: int | None = None, most: int | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """(doc_id, chunk_id, char_start, char_end, n_paragraphs, text, block_types, quote_ratio, footnote_ratio, chapter_id,
    paragraph_spans). keep filters block types before windowing."""
    if keep is not None:
        paragraphs = paragraphs.where(F.col("block_type").isin(*keep))
    rows = window_ids(paragraphs, target, most)
    parts = F.array_sort(F.collect_list(F.struct("para_idx", "char_start", "char_end", "text", "chapter_id", "block_type")))
    count = lambda kind: F.sum((F.col("block_type") == kind).cast("int"))
    out = rows.groupBy("doc_id", "chunk_id").agg(parts.alias("_p"), _ratio("blockquote").alias("quote_ratio"), _ratio("footnote").alias("footnote_ratio"), *[count(k).alias(f"_{k}") for k in ("body", "blockquote", "footnote")])
    types = F.map_filter(F.create_map(*[x for k in ("body", "blockquote", "footnote") for x in (F.lit(k), F.col(f"_{k}").cast("int"))]), lambda _, n: n > 0)
    return out.select(
        "doc_id", "chunk_id", F.col("_p")[0]["char_start"].alias("char_start"), F.element_at("_p", -1)["char_end"].alias("char_end"), F.size("_p").alias("n_paragraphs"),
        F.array_join(F.transform("_p", lambda x: x["text"]), "\n\n").alias("text"), types.alias("block_types"), "quote_ratio", "footnote_ratio", F.col("_p")[0]["chapter_id"].alias("chapter_id"),
        F.transform("_p", lambda x: F.struct(x["char_start"].alias("start"), x["char_end"].alias("end"))).alias("paragraph_spans"),
    )


def conceptual(paragraphs: DataFrame) -> DataFrame:
    return chunks(paragraphs, *CONCEPTUAL)


def formal(paragraphs: DataFrame) -> DataFrame:
    """The author's voice only: quotes and notes are left out before windowing."""
    return chunks(paragraphs, *FORMAL, keep=("body",))


