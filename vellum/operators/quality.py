"""Chunk quality: flags, penalties, score and status as one projection, and the report over all chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import WORD, WS, bind, count_words, half_even, is_blank, trim

# --- fixed values -------------------------------------------------------------------------------------------
PENALTIES = {
    "too_short": 0.18,
    "too_long": 0.16,
    "many_short_lines": 0.12,
    "many_numbers": 0.10,
    "possible_bibliography": 0.20,
    "possible_index": 0.18,
    "possible_table": 0.16,
    "ocr_noise": 0.18,
    "repeated_text": 0.18,
    "low_sentence_density": 0.12,
    "many_references": 0.12,
}
OK, BAD = 0.78, 0.45
STATUSES = ("ok", "suspect", "bad")

LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
SENTENCE_END = rf"[.!?](?:{WS}|$(?!\n))"
REFERENCE = rf"(?iu)(?<!{WORD})(?:doi|isbn|issn|http)(?!{WORD})|(?<!{WORD})(?:www\.|op\. cit\.|ibid\.|et al\.)(?={WORD})"
YEAR = rf"(?<!{WORD})(?:18|19|20)\p{{Nd}}{{2}}[a-z]?(?!{WORD})"
SURNAME = rf"^{WS}*[A-ZÀ-ÖØ-Þ][^,]{{1,40}},{WS}+"
INDEXED = rf"\.{{2,}}{WS}*\p{{Nd}}+{WS}*$"
TABULAR = rf"{WS}{{3,}}|\t|\|"
ODD = r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}.,;:!?()\[\]{}'\"/\\\-–—%$€£@#&*+=<>]"


def repeated_text_score(text: Column) -> Column:
    """The share of 5-word grams, as 64-bit hashes, that repeat an earlier one; 0 for under 80 words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"{WORD}+"), F.lit(0))

    def share(g: Column) -> Column:
        return (F.size(g) - F.size(F.array_distinct(g))) / F.size(g)

    def score(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*[w[i + k] for k in range(5)]))
        return F.when(F.size(w) < 80, 0.0).otherwise(bind(grams, share))

    return bind(words, score)


def with_quality(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """chunks with a struct quality: status, score, normalized_quality_score, flags (a list: possible_bibliography can stand twice)
    and six metrics; and score_raw, the unrounded score. A given word_count column other than 0 is taken as it is."""
    t = F.col(text_col)
    given = F.nullif(F.col("word_count"), F.lit(0)) if "word_count" in chunks.columns else F.lit(None)
    out = chunks.withColumns({"_w": F.coalesce(given, count_words(t)), "_lines": F.filter(F.split(t, LINE_BREAK, -1), lambda x: ~is_blank(x))})
    share = lambda pattern: F.size(F.filter("_lines", lambda x: x.rlike(pattern)))
    out = out.withColumns({
        "_n": F.size("_lines"), "_short": F.size(F.filter("_lines", lambda x: F.length(trim(x)) <= 35)),
        "_digits": F.regexp_count(t, F.lit(r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]")), "_alpha": F.regexp_count(t, F.lit(r"\p{L}")),
        "_sentences": F.regexp_count(t, F.lit(SENTENCE_END)), "_refs": F.regexp_count(t, F.lit(REFERENCE)) + F.regexp_count(t, F.lit(YEAR)),
        "_odd": F.regexp_count(t, F.lit(ODD)), "_repeated": repeated_text_score(t),
    })
    w, n, refs = F.col("_w"), F.col("_n"), F.col("_refs")
    lines = F.greatest(n, F.lit(1))
    digit_ratio = F.col("_digits") / F.greatest(F.lit(1), F.col("_alpha") + F.col("_digits"))
    rules = (
        ("too_short", w < 350), ("too_long", w > 1100), ("many_short_lines", (n >= 8) & (F.col("_short") / lines > 0.55)),
        ("many_numbers", (F.col("_alpha") > 0) & (digit_ratio > 0.18)), ("many_references", (refs >= 5) & (refs / F.greatest(F.lit(1), w) > 0.015)),
        ("possible_bibliography", (refs >= 6) & (n >= 4)), ("possible_bibliography", (n >= 8) & (share(SURNAME) >= 3)), ("possible_index", (n >= 8) & (share(INDEXED) >= 3)),
        ("possible_table", (n >= 5) & (share(TABULAR) / lines > 0.35)), ("ocr_noise", (F.length(t) > 0) & (F.col("_odd") / F.greatest(F.lit(1), F.length(t)) > 0.025)),
        ("repeated_text", F.col("_repeated") > 0.08), ("low_sentence_density", (w >= 150) & (F.col("_sentences") / F.greatest(F.lit(1.0), w / 100) < 1.2)),
    )
    out = out.withColumn("_flags", F.array_compact(F.array(*[F.when(rule, flag) for flag, rule in rules])))
    table = F.create_map(*[x for k, v in PENALTIES.items() for x in (F.lit(k), F.lit(v))])
    penalty = F.aggregate(F.array_distinct("_flags"), F.lit(0.0), lambda a, f: a + table[f])
    out = out.withColumn("score_raw", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - penalty)))
    score = F.col("score_raw")
    status = F.when(score < BAD, "bad").when((score >= OK) & (F.size("_flags") == 0), "ok").otherwise("suspect")
    metrics = F.struct(
        w.cast("int").alias("word_count"), n.alias("line_count"), F.when(n > 0, half_even(F.col("_short") / lines, 4)).otherwise(0.0).alias("short_line_ratio"),
        half_even(digit_ratio, 4).alias("digit_char_ratio"), F.col("_sentences").alias("sentence_count"), refs.alias("reference_hits"),
    )
    quality = F.struct(status.alias("status"), half_even(score, 4).alias("score"), half_even(score, 4).alias("normalized_quality_score"), F.col("_flags").alias("flags"), metrics.alias("metrics"))
    return out.withColumn("quality", quality).drop("_w", "_lines", "_n", "_short", "_digits", "_alpha", "_sentences", "_refs", "_odd", "_repeated", "_flags")


def records(chunks: DataFrame) -> DataFrame:
    keys = [c for c in ("doc_id", "chunk_id", "chapter_id") if c in chunks.columns]
    return with_quality(chunks).select(*keys, "quality")


def report(records: DataFrame) -> DataFrame:
    """One row: total_chunks, status_counts, flag_counts (a flag that stands twice counts twice), avg_score, min_score, max_score.
    Statuses and flags are known, so each is a sum, and all come from one aggregate over one scan."""
    score, flags = F.col("quality.score"), F.col("quality.flags")
    status = {k: F.sum((F.col("quality.status") == k).cast("bigint")) for k in sorted(STATUSES)}
    times = lambda k: F.size(F.filter(flags, lambda f: f == k))
    flag = {k: F.sum(times(k).cast("bigint")) for k in sorted(PENALTIES)}
    sums = [c.alias(f"_{k}") for k, c in (status | flag).items()]
    totals = records.agg(F.count("*").alias("total_chunks"), half_even(F.avg(score), 4).alias("avg_score"), F.min(score).alias("min_score"), F.max(score).alias("max_score"), *sums)
    as_map = lambda names: F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"_{k}").alias("value")) for k in names]), lambda e: e["value"] > 0))
    return totals.select("total_chunks", as_map(status).alias("status_counts"), as_map(flag).alias("flag_counts"), "avg_score", "min_score", "max_score", F.current_timestamp().alias("created_at"))
