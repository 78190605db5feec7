"""PDF admission: diagnostics over page texts, and the resolution memory as tables.

Pages and lines are rows; a document's metrics are aggregates, its decision one expression. Metrics decide unrounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.config import PDF_DIAGNOSTICS_VERSION
from vellum.functions.text import WORD, WS, half_even, is_blank, trim, words

from .frontmatter import with_signals

# --- fixed values -------------------------------------------------------------------------------------------
MAX_PAGES, HEAD_PAGES, PAGE_LETTERS = 120, 6, 100
OCR_DIVISORS = (1.0, 1.0, 0.5)
OCR_WEIGHTS = (0.5, 0.3, 0.2)
ABORT_TEXT_RATIO, ABORT_BODY_CONF, GOOD_DENSITY = 0.15, 0.25, 800
WARN_OCR, WARN_HEADER, WARN_NUMBERS, WARN_SHORT, WARN_BODY = 0.30, 0.50, 0.18, 0.55, 0.55
LEGIT_SINGLE = "aAeEoOiIuUyYàáâãéêíóôõúÀÁÉÍÓÚ"
LOOSE_NUMBER = rf"^{WS}*[-–—]?{WS}*\p{{Nd}}{{1,4}}{WS}*[-–—]?{WS}*$"
NUMBERED_ENTRY = rf"^{WS}*\p{{Nd}}{{1,3}}[.)]{WS}+\p{{L}}"
PUNCT_IN_WORD = rf"\p{{L}}[<>;:#~^/\\|]{WORD}"
COLOPHON = rf"(?iu)(?<!{WORD})(?:ISBN|CDD|CDU)(?!{WORD})|Cataloga|Câmara Brasileira do Livro|Copyright ©"

SEEDS = (
    # id, case_type, decision, strategy, criteria, action, flags, risk, notes
    ("image_only_scan", "image_only_scan", "abort", "abort_no_text_layer", {"text_page_ratio_lt": 0.05}, "Abortar: nenhuma página com camada textual (PDF-scan sem OCR)", ("--force-process",), "high",
     "PDFs escaneados sem OCR prévio — o diagnóstico evita gastar OCR de centenas de páginas."),
    ("low_body_confidence", "sparse_text_layer", "abort", "abort_low_body_confidence", {"body_confidence_lt": 0.25}, "Abortar: confiança de corpo principal muito baixa", (), "high",
     "Corpo muito fragmentado, esparso ou OCR muito ruim — não vale prosseguir."),
    ("poor_ocr_quality", "poor_ocr_quality", "pass_with_warning", "pass_with_warning", {"ocr_risk_ge": 0.30, "body_confidence_ge": 0.25}, "Passar com ressalva: OCR ruim detectado, mas corpo suficiente", (), "medium",
     "Mojibake, fragmentação de palavra — corpo entra mas requer atenção."),
    ("front_matter_heavy", "heavy_front_matter", "pass_with_warning", "pass_with_warning", {"front_matter_at_head": True, "body_confidence_ge": 0.30}, "Passar com ressalva: front matter pesado no começo", (), "low",
     "Sumário/índice/capa detectado — o preclean pode remover, corpo é robusto."),
    ("robust_digital_born", "robust_digital_born", "pass", "pass_direct", {"text_page_ratio_ge": 0.85, "body_confidence_ge": 0.55, "ocr_risk_lt": 0.15}, "Passar: corpo robusto, nascido-digital ou bem-convertido", (), "low",
     "PDF de alta qualidade, poucas ressalvas — segue para as trilhas."),
)
# ------------------------------------------------------------------------------------------------------------


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def ocr_risk(per_k: Column, single: Column, punct: Column) -> Column:
    parts = [w * clamp(x / d) for x, d, w in zip((per_k, single, punct), OCR_DIVISORS, OCR_WEIGHTS, strict=True)]
    return clamp(parts[0] + parts[1] + parts[2])


def nonempty_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_no, line): trimmed lines that aren't empty."""
    out = pages.select("doc_id", "page_no", "is_text", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return out.where(~is_blank(F.col("line"))).withColumn("line", trim(F.col("line")))


def header_footer(lines: DataFrame) -> DataFrame:
    """(doc_id, header_footer_ratio): the share of text pages with the commonest first or last line, over 3 pages or more."""
    text = lines.where("is_text")
    ends = text.groupBy("doc_id", "page_no").agg(F.min_by("line", "line_no").alias("head"), F.max_by("line", "line_no").alias("foot"))
    key = lambda c: trim(F.regexp_replace(F.regexp_replace(F.lower(c), rf"[\p{{Nd}}_]|(?!{WORD})(?s:.)", " "), f"{WS}+", " "))
    keyed = ends.select("doc_id", F.explode(F.array(F.struct(F.lit("head").alias("at"), key(F.col("head")).alias("key")), F.struct(F.lit("foot").alias("at"), key(F.col("foot")).alias("key")))).alias("x"))
    top = keyed.where(F.length("x.key") >= 4).groupBy("doc_id", "x.at", "x.key").count().groupBy("doc_id").agg(F.max("count").alias("top"))
    counted = ends.groupBy("doc_id").agg(F.count("*").alias("pages"))
    return counted.join(top, "doc_id", "left").select("doc_id", F.when(F.col("pages") >= 3, F.coalesce("top", F.lit(0)) / F.col("pages")).otherwise(0.0).alias("header_footer_ratio"))


def diagnose(pages: DataFrame, totals: DataFrame | None = None, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """pages (doc_id, page_no from 0, text) -> one row per document: decision, metrics, reasons. Pages from max_pages on are not
    looked at; none: all are. totals (doc_id, total_pages) gives true page numbers where they are known."""
    pages = (pages if max_pages is None else pages.where(F.col("page_no") < max_pages)).withColumn("text", F.coalesce("text", F.lit("")))
    pages = pages.withColumn("is_text", F.regexp_count("text", F.lit(r"\p{L}")) >= PAGE_LETTERS)
    n_text = F.sum(F.col("is_text").cast("int")).over(Window.partitionBy("doc_id"))
    sampled = pages.withColumn("_sampled", F.when(n_text > 0, F.col("is_text")).otherwise(True))
    token = words(F.col("text"))
    single = F.size(F.filter(token, lambda t: t.rlike(r"^\p{L}$") & ~F.lit(LEGIT_SINGLE).contains(t)))
    sampled = sampled.withColumns({"_chars": F.length("text"), "_repl": F.regexp_count("text", F.lit("�")), "_tokens": F.size(token), "_single": single, "_punct": F.size(F.filter(token, lambda t: t.rlike(PUNCT_IN_WORD)))})
    over = lambda c: F.sum(F.when(F.col("_sampled"), F.col(c)).otherwise(0))
    per_doc = sampled.groupBy("doc_id").agg(
        F.count("*").alias("pages_analyzed"), F.sum(F.col("is_text").cast("int")).alias("pages_with_text"), F.sum(F.when(F.col("is_text"), F.col("_chars")).otherwise(0)).alias("_text_chars"),
        (over("_chars") + F.sum(F.col("_sampled").cast("int")) - 1).alias("_all"), over("_repl").alias("_repl"), over("_tokens").alias("_tok"), over("_single").alias("_single"), over("_punct").alias("_punct"),
    )
    lines = nonempty_lines(pages)
    head = with_signals(lines.where(F.col("page_no") < HEAD_PAGES), "line")
    heads = head.groupBy("doc_id").agg(
        F.avg((F.length("line") < 25).cast("int")).alias("_short"), F.sum(F.col("is_structural_label").cast("int")).alias("structural_label_count"),
        F.sum(F.col("has_toc_leader").cast("int")).alias("toc_leader_count"), F.sum(F.col("line").rlike(COLOPHON).cast("int")).alias("colophon_marker_count"))
    body = lines.groupBy("doc_id").agg(F.avg(F.col("line").rlike(LOOSE_NUMBER).cast("int")).alias("_loose"), F.avg(F.col("line").rlike(NUMBERED_ENTRY).cast("int")).alias("_notes"))
    out = per_doc.join(heads, "doc_id", "left").join(body, "doc_id", "left").join(header_footer(lines), "doc_id", "left")
    out = out.fillna(0, ["_short", "structural_label_count", "toc_leader_count", "colophon_marker_count", "_loose", "_notes", "header_footer_ratio"])
    out = out.join(totals, "doc_id", "left") if totals is not None else out.withColumn("total_pages", F.lit(None).cast("bigint"))
    out = out.withColumns({
        "_ratio": F.col("pages_with_text") / F.col("pages_analyzed"), "_mean": F.coalesce(F.col("_text_chars") / F.nullif(F.col("pages_with_text"), F.lit(0)), F.lit(0.0)),
        "_per_k": F.col("_repl") / F.greatest(F.lit(1), F.col("_all")) * 1000.0, "_single_pct": F.col("_single") / F.greatest(F.lit(1), F.col("_tok")) * 100.0, "_punct_pct": F.col("_punct") / F.greatest(F.lit(1), F.col("_tok")) * 100.0,
    })
    out = out.withColumn("_risk", ocr_risk(F.col("_per_k"), F.col("_single_pct"), F.col("_punct_pct")))
    out = out.withColumn("_conf", clamp(F.col("_ratio") * clamp(F.col("_mean") / GOOD_DENSITY) * (1 - 0.5 * F.col("_risk"))))
    out = out.withColumn("front_matter_at_head", F.col("structural_label_count") + F.col("toc_leader_count") + F.col("colophon_marker_count") >= 3)
    reason = lambda cond, code, severity, value: F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(code.replace("_", " ")).alias("message"), value.cast("double").alias("value")))
    some, conf = F.col("pages_with_text") > 0, F.col("_conf")
    reasons = F.array_compact(F.array(
        reason(~some, "no_text_layer", "abort", F.col("_ratio")), reason(some & (F.col("_ratio") < ABORT_TEXT_RATIO), "sparse_text_layer", "abort", F.col("_ratio")),
        reason(some & (conf < ABORT_BODY_CONF), "low_body_confidence", "abort", conf), reason(F.col("_risk") >= WARN_OCR, "ocr_quality_risk", "warn", F.col("_risk")),
        reason((conf < WARN_BODY) & (conf >= ABORT_BODY_CONF), "moderate_body_confidence", "warn", conf), reason(F.col("front_matter_at_head"), "front_matter_at_head", "warn", F.lit(None)),
        reason(F.col("header_footer_ratio") >= WARN_HEADER, "running_header_footer", "warn", F.col("header_footer_ratio")), reason(F.col("_loose") >= WARN_NUMBERS, "loose_numbering", "warn", F.col("_loose")),
        reason((F.col("_short") >= WARN_SHORT) & (conf < WARN_BODY), "fragmented_head", "warn", F.col("_short"))))
    out = out.withColumn("reasons", reasons)
    has = lambda s: F.exists("reasons", lambda r: r["severity"] == s)
    decision = F.when(has("abort"), "abort").when(has("warn"), "pass_with_warning").otherwise("pass")
    four = lambda c, name: half_even(F.col(c), 4).alias(name)
    return out.select(
        "doc_id", F.lit(PDF_DIAGNOSTICS_VERSION).alias("version"), decision.alias("decision"), four("_conf", "body_confidence"), four("_risk", "ocr_risk"), F.coalesce("total_pages", "pages_analyzed").alias("total_pages"),
        "pages_analyzed", "pages_with_text", four("_ratio", "text_page_ratio"), half_even(F.col("_mean"), 1).alias("mean_chars_per_text_page"), four("_short", "short_line_ratio_head"), four("header_footer_ratio", "repeated_header_footer_ratio"),
        "front_matter_at_head", "structural_label_count", "toc_leader_count", "colophon_marker_count", four("_loose", "loose_numbering_ratio"), four("_notes", "note_density"), four("_per_k", "ocr_replacement_per_k"),
        four("_single_pct", "ocr_single_letter_pct"), four("_punct_pct", "ocr_punct_in_word_pct"), "reasons",
    )


MOST_PATTERNS = 10_000
CRITERIA = ("text_page_ratio_lt", "text_page_ratio_ge", "body_confidence_lt", "body_confidence_ge", "ocr_risk_lt", "ocr_risk_ge", "front_matter_at_head", "header_footer_ratio_ge", "short_line_ratio_head_ge")
PATTERN_SCHEMA = (
    "ord int, id string, case_type string, decision string, resolution_strategy string, "
    + ", ".join(f"{c} {'boolean' if c == 'front_matter_at_head' else 'double'}" for c in CRITERIA)
    + ", recommended_action string, recommended_cli_flags array<string>, residual_risk string, notes string"
)
CASE_SCHEMA = "timestamp string, path string, raw_hash string, decision string, strategy_id string, resolution_method string, notes string, diagnosis string"


def seed_patterns(spark: SparkSession) -> DataFrame:
    rows = [(k, i, case, decision, strategy, *[criteria.get(c) for c in CRITERIA], action, list(flags), risk, notes) for k, (i, case, decision, strategy, criteria, action, flags, risk, notes) in enumerate(SEEDS)]
    return spark.createDataFrame(rows, PATTERN_SCHEMA)


def match_patterns(diagnoses: DataFrame, patterns: DataFrame) -> DataFrame:
    """(doc_id, rank, pattern columns, confidence): all patterns that a (rounded) diagnosis meets, by score, then registry order. The registry is
    tens of rows, so it is broadcast, of MOST_PATTERNS at most; a null criterion is ignored."""
    if patterns.limit(MOST_PATTERNS + 1).count() > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    metric = {"text_page_ratio": "text_page_ratio", "body_confidence": "body_confidence", "ocr_risk": "ocr_risk", "header_footer_ratio": "repeated_header_footer_ratio", "short_line_ratio_head": "short_line_ratio_head"}
    cond = F.lit(True)
    for c in CRITERIA:
        if c == "front_matter_at_head":
            cond = cond & (F.col(f"p.{c}").isNull() | (F.col(f"p.{c}") == F.col(f"d.{c}")))
        else:
            value = F.col("d." + metric[c[:-3]])
            cond = cond & (F.col(f"p.{c}").isNull() | ((value < F.col(f"p.{c}")) if c.endswith("_lt") else (value >= F.col(f"p.{c}"))))
    met = diagnoses.alias("d").join(F.broadcast(patterns.alias("p")), cond)
    gap = F.abs(F.col("p.text_page_ratio_lt") - F.col("d.text_page_ratio"))
    ratio = F.when(gap > 0.2, 0.8).when(gap < 0.05, 0.9).otherwise(1.0)
    body_gap = F.abs(F.col("p.body_confidence_lt") - F.col("d.body_confidence"))
    body = F.when((body_gap > 0.2) | (body_gap < 0.05), 0.85).otherwise(1.0)
    score = F.coalesce(ratio, F.lit(1.0)) * F.coalesce(body, F.lit(1.0))
    out = met.select("d.doc_id", "p.id", "p.case_type", F.col("p.decision").alias("pattern_decision"), "p.resolution_strategy", "p.recommended_action", "p.residual_risk", score.alias("confidence"), "p.ord")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("confidence"), "ord"))
    return out.withColumn("rank", rank).drop("ord")


def cases(diagnoses: DataFrame, best: DataFrame, succeeded: bool = True) -> DataFrame:
    """Rows for the case log: a success is logged as pass, whatever the diagnosis, which is kept beside it; by the best pattern or,
    without one, by default."""
    d = diagnoses.join(best.where("rank = 1").select("doc_id", F.col("id").alias("strategy_id")), "doc_id", "left")
    path = F.col("path") if "path" in d.columns else F.col("doc_id").cast("string")
    raw = F.col("raw_hash") if "raw_hash" in d.columns else F.lit(None).cast("string")
    known = F.col("strategy_id").isNotNull()
    notes = F.concat(F.lit("processed" if succeeded else "refused"), F.lit("; pattern: "), F.coalesce("strategy_id", F.lit("none")))
    return d.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), path.alias("path"), raw.alias("raw_hash"), F.when(F.lit(succeeded), "pass").otherwise(F.col("decision")).alias("decision"),
        "strategy_id", F.when(known, "pattern_match").otherwise("default").alias("resolution_method"), notes.alias("notes"), F.to_json(F.struct(*[c for c in diagnoses.columns if c not in ("doc_id", "path", "raw_hash")])).alias("diagnosis"),
    )


def usage(case_log: DataFrame) -> DataFrame:
    """Per strategy: times_applied, last_applied and an example, from the log instead of mutable counters."""
    example = F.struct(F.element_at(F.split("path", "/"), -1).alias("filename"), "raw_hash", "timestamp", "decision", F.get_json_object("diagnosis", "$.body_confidence").cast("double").alias("body_confidence"))
    return case_log.where("strategy_id is not null").groupBy("strategy_id").agg(F.count("*").alias("times_applied"), F.max("timestamp").alias("last_applied"), F.max_by(example, F.struct("timestamp", "path")).alias("example"))
