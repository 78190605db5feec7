"""Track eligibility of chunks: an interval join for class profiles, then a cascade of reasons.

The join has doc_id as its equality key and the spans' overlap as a residual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import trim

# --- fixed values -------------------------------------------------------------------------------------------
WORD_PATTERN = r"[A-Za-zÀ-ÖØ-öø-ÿ][A-Za-zÀ-ÖØ-öø-ÿ'_-]*"
THRESHOLDS = {
    "conceitual": {
        "navigation_noise": 0.2,
        "editorial_discourse": 0.45,
        "quotation_material": 0.55,
        "quote_ratio": 0.5,
        "footnote_material": 0.35,
        "footnote_ratio": 0.2,
        "min_tokens": 18,
    },
    "formal": {
        "navigation_noise": 0.2,
        "editorial_discourse": 0.45,
        "quotation_material": 0.55,
        "quote_ratio": 0.5,
        "footnote_material": 0.35,
        "footnote_ratio": 0.2,
        "min_tokens": 18,
    },
}
COPYRIGHT = ("all rights reserved", "copyright")
FRONT_MARKERS = (
    "library of congress", "cataloging in publication", "preface", "contents", "dedication", "permissions acknowledgments",
    "published in the united states", "pantheon books", "includes bibliographical references", "isbn ",
)
CROSS_SELL = ("compre agora e leia", "discover your next great read", "personalized book picks", "sign up now")
TRANSLATION = ("tradução", "traducao", "translation", "translated by")
OPENING = (*TRANSLATION, "sumário", "contents", "prefácio", "preface", "isbn")
REASONS = {
    "copyright": "paratexto editorial/copyright",
    "front": "front matter residual",
    "cross_sell": "cross-sell/paratexto editorial",
    "navigation": "navegação ou embalagem editorial",
    "editorial": "discurso editorial dominante",
    "quotation": "citação dominante",
    "footnote": "nota dominante",
    "short": "bloco curto demais para unidade analítica estável",
}


def class_profile(chunks: DataFrame, classification: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, profile): of the characters that a chunk's envelope shares with paragraphs, the fraction of each class; none shared, an empty map."""
    p = classification.select("doc_id", F.col("char_start").alias("_s"), F.col("char_end").alias("_e"), "block_class")
    met = chunks.select("doc_id", "chunk_id", "char_start", "char_end").join(p, "doc_id").where("_s < char_end and char_start < _e")
    shared = met.groupBy("doc_id", "chunk_id", "block_class").agg(F.sum(F.least("char_end", "_e") - F.greatest("char_start", "_s")).alias("n"))
    entry = F.array_sort(F.collect_list(F.struct("block_class", "n")))
    rolled = shared.groupBy("doc_id", "chunk_id").agg(entry.alias("_p"), F.sum("n").alias("_t"))
    return rolled.select("doc_id", "chunk_id", F.map_from_entries(F.transform("_p", lambda x: F.struct(x["block_class"], x["n"] / F.col("_t")))).alias("profile"))


def tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), F.lower)


def _any(text: Column, markers: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for m in markers:
        hit = hit | text.contains(m)
    return hit


def generic_reason(text: Column, chunk_id: Column) -> Column:
    low, at = F.lower(text), F.coalesce(chunk_id, F.lit(9999))
    paragraphs = F.filter(F.transform(F.split(text, "\n\n", -1), trim), lambda p: p != "")
    mean = F.when(F.size(paragraphs) > 0, F.aggregate(paragraphs, F.lit(0), lambda a, p: a + F.length(p)) / F.greatest(F.size(paragraphs), F.lit(1))).otherwise(F.length(text))
    upper = F.regexp_count(text, F.lit(r"\p{IsUppercase}")) / F.greatest(F.length(text), F.lit(1))
    opening = (at <= 4) & (F.size(paragraphs) >= 3) & (mean <= 85) & ((upper >= 0.12) | _any(low, OPENING))
    return (
        F.when(_any(low, COPYRIGHT), REASONS["copyright"]).when(_any(low, FRONT_MARKERS), REASONS["front"]).when(_any(low, CROSS_SELL), REASONS["cross_sell"])
        .when(((at <= 2) & _any(low, TRANSLATION)) | opening, REASONS["front"])
    )


def class_reason(profile: Column, quote_ratio: Column, footnote_ratio: Column, th: Column) -> Column:
    share = lambda k: F.coalesce(profile[k], F.lit(0.0))
    return (
        F.when(share("navigation_noise") >= th["navigation_noise"], REASONS["navigation"]).when(share("editorial_discourse") >= th["editorial_discourse"], REASONS["editorial"])
        .when((share("quotation_material") >= th["quotation_material"]) | (quote_ratio >= th["quote_ratio"]), REASONS["quotation"])
        .when((share("footnote_material") >= th["footnote_material"]) | (footnote_ratio >= th["footnote_ratio"]), REASONS["footnote"])
    )


def tracks(spark: SparkSession, names: tuple[str, ...] = tuple(THRESHOLDS)) -> DataFrame:
    unknown = set(names) - set(THRESHOLDS)
    if unknown:
        raise ValueError(f"unknown track {sorted(unknown)}: use {list(THRESHOLDS)}")
    fields = list(next(iter(THRESHOLDS.values())))
    return spark.createDataFrame([(k, tuple(float(THRESHOLDS[k][f]) for f in fields)) for k in names], f"track string, th struct<{', '.join(f'{f}: double' for f in fields)}>")


def eligibility(chunks: DataFrame, classification: DataFrame, names: tuple[str, ...] = tuple(THRESHOLDS)) -> DataFrame:
    """(doc_id, chunk_id, track, is_noise, reason) of each chunk for each track (two rows, broadcast)."""
    known = chunks.join(class_profile(chunks, classification), ["doc_id", "chunk_id"], "left")
    known = known.withColumn("_generic", generic_reason(F.col("text"), F.col("chunk_id"))).withColumn("_tokens", F.size(tokens(F.col("text"))))
    each = known.crossJoin(F.broadcast(tracks(chunks.sparkSession, names)))
    reason = F.coalesce("_generic", class_reason(F.col("profile"), F.col("quote_ratio"), F.col("footnote_ratio"), F.col("th")), F.when(F.col("_tokens") < F.col("th.min_tokens"), REASONS["short"]))
    return each.select("doc_id", "chunk_id", "track", reason.isNotNull().alias("is_noise"), reason.alias("reason"))
