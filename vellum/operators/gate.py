"""The gate: contract checks on bodies and on paragraphs against bodies, as rows.

Checks come in contract order. A document's lines meet once, in one partition: findings and, for its own paragraphs, body and
spans come out of one aggregate by document. Paragraphs from elsewhere meet their body once, as arrays of spans. Spans
are cut out of the body's fixed-width form, so the work is linear in its length. Details hold the first MOST offenders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.config import BLOCK_TOKENS, BQ_CLOSE, BQ_OPEN, CONTRACT_VERSION, ENGINE_VERSION, REF_CLOSE, REF_OPEN, Config
from vellum.functions.text import WS, bind, body_size, freeze_key, is_blank, sha256, strip_sentinels

from .clean import noise_patterns
from .lines import by_doc, explode_lines, with_offsets
from .segment import with_depth

STATIC = ("sentinels_isolated", "sentinels_balanced", "noteref_balanced", "body_isolated", "body_hashable", "provenance_frozen", "body_min_size")
ROUNDTRIP = ("roundtrip_axis", "roundtrip_coverage")
MOST = 10
_BLANK = r"[\t\x0b\f\r \x1c-\x1f\x85\p{Z}]*"


def provenance() -> Column:
    return F.struct("source_format", "source_edition", "translation_layer")


def _noteref_error(body: Column) -> Column:
    """Of the first close without open, or else of opens that are left: (reason, char_start, depth)."""
    parts = F.split(body, f"(?={REF_OPEN}|{REF_CLOSE})", -1)
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("bad"))

    def step(a: Column, part: Column) -> Column:
        depth = a["depth"] + part.startswith(REF_OPEN).cast("int") - part.startswith(REF_CLOSE).cast("int")
        return F.struct((a["at"] + F.length(part)).alias("at"), depth.alias("depth"), F.coalesce(a["bad"], F.when(depth < 0, a["at"])).alias("bad"))

    error = lambda reason, at, depth: F.struct(F.lit(reason).alias("reason"), at.cast("int").alias("char_start"), depth.cast("int").alias("depth"))
    none = F.lit(None)
    return bind(F.aggregate(parts, zero, step), lambda a: F.when(a["bad"].isNotNull(), error("close without open", a["bad"], none)).when(a["depth"] != 0, error("open without close", none, a["depth"])))


def _marked(lines: DataFrame, config: Config) -> DataFrame:
    """Lines with what the checks of markers and noise need of them, and offsets, step and token."""
    lines = with_depth(with_offsets(lines))
    lines = lines.withColumn("_before", F.coalesce(F.lag("depth").over(by_doc()), F.lit(0)))
    lines = lines.withColumn("_level", F.when(F.col("step") == -1, F.col("_before")).otherwise(F.col("depth")))
    at_level = Window.partitionBy("doc_id", "_level").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_opener", F.last(F.when(F.col("step") == 1, F.col("token")), True).over(at_level))
    closes = F.col("step") == -1
    wanted = F.when(F.col("_opener") == BQ_OPEN, BQ_CLOSE).otherwise(BLOCK_TOKENS[3])
    holds, leaks = F.lit(False), F.lit(0)
    for token in BLOCK_TOKENS:
        holds = holds | F.col("line").contains(token)
    for p in noise_patterns(config):
        leaks = leaks + F.col("line").rlike(p).cast("int")
    marker = F.col("step") != 0
    return lines.withColumns({
        "_offends": holds & ~marker, "_leaks": F.when(marker, 0).otherwise(leaks),
        "_reason": F.when(closes & (F.col("_before") == 0), "close without open").when(closes & (F.col("token") != wanted), "close does not match open"),
    })


def _findings() -> list[Column]:
    """Aggregates by document over _marked lines."""
    place = F.struct("char_start", "line")
    first = lambda cond: F.slice(F.array_sort(F.collect_list(F.when(cond, place))), 1, MOST)
    return [
        F.sum(F.col("_offends").cast("int")).alias("offenders"), first(F.col("_offends")).alias("first_offenders"), F.sum("_leaks").alias("leaks"), first(F.col("_leaks") > 0).alias("first_leaks"),
        F.min(F.when(F.col("_reason").isNotNull(), F.struct("char_start", F.col("_reason").alias("reason"), F.col("_opener").alias("open"), F.col("token").alias("close")))).alias("_error"),
        F.max(F.struct("line_no", "depth")).alias("_last"),
    ]


def _with_block_error(found: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    unclosed = F.struct(F.lit(None).cast("int").alias("char_start"), F.lit("open without close").alias("reason"), none.alias("open"), none.alias("close"))
    return found.withColumn("block_error", F.coalesce("_error", F.when(F.col("_last.depth") > 0, unclosed))).drop("_error", "_last")


def line_findings(bodies: DataFrame, config: Config) -> DataFrame:
    """Per document with lines: offenders (lines with a marker that isn't alone), block_error, leaks (lines with noise, for the
    built-in patterns together and for each extra one), and the first of them."""
    return _with_block_error(_marked(explode_lines(bodies, "body"), config).groupBy("doc_id").agg(*_findings()))


def _row(order: int, code: str, passed: Column, details: Column) -> Column:
    return F.struct(F.lit(order).alias("ord"), F.lit(code).alias("code"), F.coalesce(passed, F.lit(False)).alias("passed"), F.to_json(details).alias("details"))


def _static_rows(config: Config) -> Column:
    """The static checks of a row with findings (null: no lines), body and provenance."""
    none, given = (lambda c: F.coalesce(c, F.lit(0)) == 0), (lambda c: F.coalesce(F.length(c), F.lit(0)) > 0)
    one = lambda name, c: F.struct(F.col(c).alias(name) if isinstance(c, str) else c.alias(name))
    checks = (
        (none("offenders"), F.struct("offenders", "first_offenders")), (F.col("block_error").isNull(), one("error", "block_error")), (F.col("_ref").isNull(), one("error", "_ref")),
        (none("leaks"), F.struct("leaks", "first_leaks")), (F.col("body").isNotNull(), one("body_hash", sha256(F.col("body")))),
        (given("source_format") & given("source_edition"), one("provenance", provenance())), (F.col("_size") >= config.min_size, F.struct(F.col("_size").alias("size"), F.lit(config.min_size).alias("min_size"), F.lit(config.unit).alias("unit"))),
    )
    return F.array(*[_row(k, code, passed, details) for k, (code, (passed, details)) in enumerate(zip(STATIC, checks, strict=True))])


def _measured(bodies: DataFrame, config: Config) -> DataFrame:
    return bodies.withColumn("_size", body_size(F.col("body"), config.unit)).withColumn("_ref", _noteref_error(F.col("body")))


def static_checks(bodies: DataFrame, config: Config | None = None) -> DataFrame:
    """bodies (doc_id, body, source_format, source_edition, translation_layer) -> (doc_id, ord, code, passed, details)."""
    config = config or Config()
    found = bodies.join(line_findings(bodies, config), "doc_id", "left")
    return _measured(found, config).select("doc_id", F.inline(_static_rows(config)))


def _roundtrip_rows(body: Column, spans: Column) -> Column:
    """spans (char_start, char_end, text), sorted. The body is read as four bytes a character, of which any span is a slice."""
    wide = lambda c: F.encode(c, "UTF-32")
    cut = lambda b, lo, hi: F.decode(F.substring(b, 4 * lo + 1, 4 * F.greatest(hi - lo, F.lit(0))), "UTF-32")
    masked = body
    for token in BLOCK_TOKENS:
        masked = F.regexp_replace(masked, f"(?md)^({_BLANK}){token}({_BLANK})$", "$1" + " " * len(token) + "$2")
    wrong = bind(wide(body), lambda b: F.filter(spans, lambda p: ~strip_sentinels(cut(b, p["char_start"], p["char_end"])).eqNullSafe(p["text"])))
    places = lambda: F.array().cast("array<struct<char_start:int,char_end:int>>")
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("last"), F.lit(0).alias("overlaps"), F.lit(0).alias("gaps"), places().alias("found"))

    def walk(m: Column) -> Column:
        def past(a: Column, hi: Column, end: Column, last: Column, overlaps: Column) -> Column:
            solid = F.when(hi > a["end"], F.length(F.regexp_replace(cut(m, a["end"], hi), WS, ""))).otherwise(0)

            def gap(n: Column) -> Column:
                more = F.when((n > 0) & (F.size(a["found"]) < MOST), F.array(F.struct(a["end"].alias("char_start"), hi.alias("char_end")))).otherwise(places())
                return F.struct(end.alias("end"), last.alias("last"), overlaps.alias("overlaps"), (a["gaps"] + n).alias("gaps"), F.concat(a["found"], more).alias("found"))

            return bind(solid, gap)

        step = lambda a, p: past(a, p["char_start"], F.greatest(a["end"], p["char_end"]), p["char_end"], a["overlaps"] + (p["char_start"] < a["last"]).cast("int"))
        size = (F.octet_length(m) / 4).cast("int")
        return F.aggregate(spans, zero, step, lambda a: past(a, size, size, a["last"], a["overlaps"]))

    axis = lambda w: _row(7, ROUNDTRIP[0], F.size(w) == 0, F.struct(F.size(w).alias("mismatches"), F.slice(w, 1, MOST).alias("first_mismatches")))
    cover = lambda a: _row(8, ROUNDTRIP[1], (a["overlaps"] == 0) & (a["gaps"] == 0), F.struct(a["overlaps"].alias("overlaps"), a["gaps"].alias("gaps"), a["found"].alias("first_gaps")))
    return F.array(bind(wrong, axis), bind(bind(wide(masked), walk), cover))


_SPANS = "array<struct<char_start:int,char_end:int,text:string>>"


def roundtrip_checks(bodies: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """paragraphs may come from anywhere: each span without markers must give its text (C1); spans must not overlap and must
    cover all but white space and marker lines (C1')."""
    spans = F.array_sort(F.collect_list(F.struct("char_start", "char_end", "text")))
    both = bodies.select("doc_id", "body").join(paragraphs.groupBy("doc_id").agg(spans.alias("spans")), "doc_id", "left")
    both = both.withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))
    return both.select("doc_id", F.inline(_roundtrip_rows(F.col("body"), F.col("spans"))))


def checked_lines(lines: DataFrame, config: Config) -> DataFrame:
    """One row for each document that has lines: body, findings, and the spans of its own paragraphs, from one aggregate."""
    solid = (F.col("step") == 0) & ~is_blank(F.col("line"))
    span = F.when(solid, F.struct("char_start", "char_end", strip_sentinels(F.col("line")).alias("text")))
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line", span.alias("span"))))
    found = _with_block_error(_marked(lines, config).groupBy("doc_id").agg(rows.alias("_rows"), *_findings()))
    spans = F.filter(F.transform("_rows", lambda x: x["span"]), lambda s: s.isNotNull())
    return found.withColumn("body", F.array_join(F.transform("_rows", lambda x: x["line"]), "\n")).withColumn("spans", spans).drop("_rows")


def own_checks(docs: DataFrame, lines: DataFrame, config: Config | None = None) -> DataFrame:
    """docs (doc_id, provenance columns, ...) with body (empty, if the document has no lines) and checks, an array of all check
    rows: the lines are those of the body, and its paragraphs are its own."""
    config = config or Config()
    found = docs.join(checked_lines(lines, config), "doc_id", "left")
    found = found.withColumn("body", F.coalesce("body", F.lit(""))).withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))
    checks = F.concat(_static_rows(config), _roundtrip_rows(F.col("body"), F.col("spans")))
    return _measured(found, config).withColumn("checks", checks).select(*docs.columns, "body", "checks")


def results(checks: DataFrame, bodies: DataFrame, config: Config | None = None) -> DataFrame:
    """Per document: passed, first_failure (in contract order), contract_version, body_hash, body_size, freeze_key."""
    config = config or Config()
    rolled = checks.groupBy("doc_id").agg(F.bool_and("passed").alias("passed"), F.min(F.when(~F.col("passed"), F.struct("ord", "code"))).alias("_first"))
    raw = F.col("raw_hash") if "raw_hash" in bodies.columns else F.lit(None).cast("string")
    filling = F.col("filling_hash") if "filling_hash" in bodies.columns else F.lit(None).cast("string")
    return rolled.join(bodies, "doc_id").select(
        "doc_id", "passed", F.col("_first.code").alias("first_failure"), F.lit(CONTRACT_VERSION).alias("contract_version"), sha256(F.col("body")).alias("body_hash"),
        body_size(F.col("body"), config.unit).alias("body_size"), freeze_key(raw, filling, ENGINE_VERSION).alias("freeze_key"),
    )


def gate_passes(bodies: DataFrame, paragraphs: DataFrame, config: Config | None = None) -> DataFrame:
    """(doc_id, passed) of all checks."""
    checks = static_checks(bodies, config).unionByName(roundtrip_checks(bodies, paragraphs))
    return checks.groupBy("doc_id").agg(F.bool_and("passed").alias("passed"))
