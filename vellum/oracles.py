"""DuckDB SQL for the queries of the registry, written on its own from the contract: common table expressions and what each query selects."""

from __future__ import annotations

import hashlib
import re

from vellum.config import CONCEPTUAL, ENGINE_VERSION, FORMAL, FRONT_MATTER_VERSION, NOISE_PATTERNS
from vellum.functions.text import repertoire_hash
from vellum.operators.eligibility import COPYRIGHT, CROSS_SELL, FRONT_MARKERS, OPENING, REASONS, THRESHOLDS, TRANSLATION
from vellum.operators.frontmatter import CHAPTER_WORDS, CONNECTIVES, EDITORIAL_PREFIXES, ORDINALS, STRUCTURAL_LABELS
from vellum.operators.pdf import LEGIT_SINGLE, SEEDS
from vellum.operators.quality import PENALTIES

#: Plain SQL that Spark and DuckDB read alike.
DECORATED = """concat(
 case when doc_id % 4 = 0 then concat('Capa',chr(10),chr(10),'Sumário',chr(10),chr(10),'Capítulo I ..... 3',chr(10),chr(10),
      'Capítulo II ..... 9',chr(10),chr(10),'Capítulo III',chr(10),chr(10)) else '' end,
 case when doc_id % 5 = 0 then concat('ISBN 85-000-0000-0',chr(10),'http://example.com/scan',chr(10)) else '' end,
 case when doc_id % 3 = 0 then concat('⟦PRL:BQ⟧',chr(10),'Quoted voice one.',chr(10),'⟦PRL:FN⟧',chr(10),'Nested note.',chr(10),
      '⟦/PRL:FN⟧',chr(10),'⟦/PRL:BQ⟧',chr(10)) else '' end,
 replace(replace(coalesce(text,''),chr(10),concat(chr(10),'- 12 -',chr(10),chr(10))),', ',concat('-',chr(10))),
 case when doc_id % 7 = 0 then concat(chr(10),'See⟦PRL:REF⟧1⟦/PRL:REF⟧ here.',chr(10),'⟦PRL:FN⟧',chr(10),'1. The note, 1984.',chr(10),'⟦/PRL:FN⟧') else '' end,
 case when doc_id % 11 = 0 then concat(chr(10),'⟦/PRL:BQ⟧') when doc_id % 13 = 0 then concat(chr(10),'x ⟦PRL:BQ⟧')
      when doc_id % 17 = 0 then concat(chr(10),'⟦PRL:REF⟧') else '' end)"""

SENTINEL = "trim(line) IN ('⟦PRL:BQ⟧', '⟦/PRL:BQ⟧', '⟦PRL:FN⟧', '⟦/PRL:FN⟧')"
STRIP = "regexp_replace({}, '⟦/?PRL:(BQ|FN|REF)⟧', '', 'g')"
NOISE = " OR ".join(f"regexp_matches(line, '{p}')" for p in NOISE_PATTERNS)
PAGE_NUMBER = r"regexp_matches(line, '^\s*[-–—]?\s*[0-9]{1,4}\s*[-–—]?\s*$')"
LAST = "(PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
IN_ORDER = "(PARTITION BY doc_id ORDER BY line_no)"

DOCS = f"docs AS (SELECT doc_id, {DECORATED} AS text FROM documents)"
LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM docs)"
OFFSETS = f"offsets AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS char_start FROM lines)"


def _no_noise(source: str, name: str) -> str:
    return f"{name} AS (SELECT * FROM {source} WHERE {SENTINEL} OR NOT ({NOISE}))"


def _no_page_numbers(source: str, name: str) -> str:
    return f"{name} AS (SELECT * FROM {source} WHERE {SENTINEL} OR NOT {PAGE_NUMBER})"


def _dehyphenated(source: str, name: str) -> str:
    return rf"""{name}_a AS (SELECT *, last_value(CASE WHEN trim(line) <> '-' THEN NOT ({SENTINEL}) AND regexp_matches(line, '[\p{{L}}\p{{N}}_]-\s*$') END IGNORE NULLS) OVER {LAST} AS flag FROM {source}),
    {name}_b AS (SELECT *, coalesce(lag(flag) OVER {IN_ORDER}, false) AND trim(line) <> '' AND NOT ({SENTINEL}) AS joins FROM {name}_a),
    {name}_c AS (SELECT *, sum((NOT joins)::INT) OVER {LAST} AS island, coalesce(lead(joins) OVER {IN_ORDER}, false) AS goes_on FROM {name}_b),
    {name} AS (SELECT doc_id, min(line_no) AS line_no, string_agg(CASE WHEN goes_on THEN regexp_replace(CASE WHEN joins THEN ltrim(line) ELSE line END, '-\s*$', '') WHEN joins THEN ltrim(line) ELSE line END, '' ORDER BY line_no) AS line FROM {name}_c GROUP BY doc_id, island)"""


def _reflowed(source: str, name: str) -> str:
    solid = f"NOT ({SENTINEL}) AND trim(line) <> ''"
    return rf"""{name}_a AS (SELECT *, {solid} AND right(rtrim(line), 1) NOT IN ('.', '!', '?', ':', ';', '”', '"', ')', ']', '…') AS loose FROM {source}),
    {name}_b AS (SELECT *, coalesce(lag(loose) OVER {IN_ORDER}, false) AND {solid} AND regexp_matches(trim(line), '^\p{{Ll}}') AS joins FROM {name}_a),
    {name}_c AS (SELECT *, sum((NOT joins)::INT) OVER {LAST} AS island, coalesce(lead(joins) OVER {IN_ORDER}, false) AS goes_on FROM {name}_b),
    {name} AS (SELECT doc_id, min(line_no) AS line_no, string_agg(CASE WHEN joins THEN trim(line) WHEN goes_on THEN rtrim(line) ELSE line END, ' ' ORDER BY line_no) AS line FROM {name}_c GROUP BY doc_id, island)"""


CLEAN = ",\n".join((_no_noise("lines", "c1"), _no_page_numbers("c1", "c2"), _dehyphenated("c2", "c3"), _reflowed("c3", "c4")))
BODY = "cleaned AS (SELECT docs.doc_id, coalesce(b.body, '') AS body FROM docs LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS body FROM c4 GROUP BY doc_id) b USING (doc_id))"


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _signals(source: str, name: str) -> str:
    """Signals of (doc_id, idx, text)."""
    edge = r"($|[^\p{L}\p{N}_])"
    return rf"""{name}_a AS (SELECT *, trim(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g')) AS key, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::INT AS word_count,
        len(regexp_extract_all(regexp_replace(text, '\.(\s*\.)+', '.', 'g'), '[.!?…]'))::INT AS sentences, regexp_matches(text, '[.!?…]["''”’)\]»]*\s*$') AS ends_sentence,
        regexp_matches(text, '(\.\.+|\.(\s\.){{2,}}|…)\s*[0-9]{{1,4}}\s*$') AS has_toc_leader FROM {source}),
    {name}_b AS (SELECT *, regexp_matches(key, '(^|[^\p{{L}}\p{{N}}_])({"|".join(CONNECTIVES)}){edge}') AS has_connective, key IN ({_quoted(STRUCTURAL_LABELS)}) AS is_structural_label,
        regexp_matches(key, '^({"|".join(CHAPTER_WORDS)}){edge}|^({"|".join(ORDINALS)})[oa] parte{edge}') AS is_numbered_chapter FROM {name}_a),
    {name}_c AS (SELECT *, NOT has_toc_leader AND ((word_count >= 25 AND sentences >= 1) OR (sentences >= 2 AND word_count >= 12) OR (has_connective AND word_count >= 20)) AS is_discursive FROM {name}_b),
    {name}_d AS (SELECT *, NOT is_discursive AND NOT ends_sentence AND NOT has_connective AND word_count BETWEEN 1 AND 20 AS is_heading_like,
        NOT is_discursive AND word_count <= 20 AND regexp_matches(key, '^({"|".join(EDITORIAL_PREFIXES)})') AS is_editorial_heading,
        is_structural_label OR is_numbered_chapter OR has_toc_leader AS is_strong_nav_marker FROM {name}_c),
    {name} AS (SELECT *, NOT is_discursive AND (is_strong_nav_marker OR is_heading_like OR is_editorial_heading) AS is_nav_candidate, is_editorial_heading OR is_numbered_chapter AS is_section_heading FROM {name}_d)"""


def _labels(source: str, name: str) -> str:
    """label of (doc_id, idx, signals), the front zone only."""
    return f"""{name}_i AS (SELECT *, idx - row_number() OVER (PARTITION BY doc_id, is_nav_candidate ORDER BY idx) AS island, coalesce(lead(is_discursive) OVER (PARTITION BY doc_id ORDER BY idx), false) AS then_prose FROM {source}),
    {name}_r AS (SELECT doc_id, min(idx) AS s, max(idx) AS e FROM {name}_i WHERE is_nav_candidate GROUP BY doc_id, island HAVING count(*) >= 4 AND bool_or(is_strong_nav_marker)),
    {name}_f AS (SELECT doc_id, min(s) AS s, arg_min(e, s) AS e FROM {name}_r GROUP BY doc_id),
    {name} AS (SELECT i.*, CASE WHEN idx = e AND then_prose AND (is_section_heading OR is_heading_like) AND NOT has_toc_leader AND NOT is_structural_label THEN CASE WHEN is_editorial_heading THEN 'editorial_discourse' ELSE 'main_body_start' END
        WHEN idx BETWEEN s AND e THEN 'navigation_noise' WHEN is_structural_label THEN 'navigation_noise' WHEN idx = e + 1 THEN 'main_body_start' END AS label FROM {name}_i i LEFT JOIN {name}_f USING (doc_id))"""


FRONT = "front AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS idx, trim(line) AS text FROM lines WHERE trim(line) <> '' QUALIFY idx < 80)"
DEPTH = f"""steps AS (SELECT *, trim(line) AS token, CASE WHEN trim(line) IN ('⟦PRL:BQ⟧', '⟦PRL:FN⟧') THEN 1 WHEN trim(line) IN ('⟦/PRL:BQ⟧', '⟦/PRL:FN⟧') THEN -1 ELSE 0 END AS step FROM offsets),
    sums AS (SELECT *, sum(step) OVER {LAST} AS total FROM steps),
    depths AS (SELECT *, total - least(0, min(total) OVER {LAST}) AS depth FROM sums)"""
PARAGRAPHS = f"""kinds AS (SELECT *, last_value(CASE token WHEN '⟦PRL:BQ⟧' THEN 'blockquote' WHEN '⟦PRL:FN⟧' THEN 'footnote' END IGNORE NULLS) OVER (PARTITION BY doc_id, depth ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kind FROM depths),
    paras AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1)::INT AS para_idx, char_start, (char_start + length(line))::INT AS char_end, {STRIP.format("line")} AS text, line AS raw,
        CASE WHEN depth = 0 THEN 'body' ELSE kind END AS block_type FROM kinds WHERE step = 0 AND trim(line) <> '')"""
CLASSES = ",\n".join((
    "body_paras AS (SELECT doc_id, para_idx, row_number() OVER (PARTITION BY doc_id ORDER BY para_idx) - 1 AS idx, text FROM paras WHERE block_type = 'body')",
    "body_front AS (SELECT * FROM body_paras WHERE idx < 80)", _signals("body_front", "bs"), _labels("bs", "bl"),
    """classes AS (SELECT p.*, CASE WHEN block_type = 'blockquote' THEN 'quotation_material' WHEN block_type = 'footnote' THEN 'footnote_material' WHEN label = 'navigation_noise' THEN label
        WHEN label = 'editorial_discourse' THEN label ELSE 'main_body' END AS block_class, contains(raw, '⟦PRL:REF⟧') AS has_note_call FROM paras p LEFT JOIN (SELECT doc_id, para_idx, label FROM bl) USING (doc_id, para_idx))""",
))
STRUCTURE = ",\n".join((DOCS, LINES, OFFSETS, DEPTH, PARAGRAPHS))


def _greedy(source: str, target: int, most: int) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY para_idx) AS k, length(text) AS n FROM {source}),
    fold AS (SELECT doc_id, k, 0 AS chunk_id, (n >= {target})::INT AS now, CASE WHEN n >= {target} THEN 0 ELSE n END AS held, n < {target} AS is_open FROM numbered WHERE k = 1
        UNION ALL SELECT doc_id, k, chunk_id, chunk_id + (h >= {target})::INT, CASE WHEN h >= {target} THEN 0 ELSE h END, h < {target} FROM (
            SELECT x.doc_id, x.k, f.now + (f.is_open AND f.held + x.n > {most})::INT AS chunk_id, CASE WHEN f.is_open AND f.held + x.n > {most} THEN x.n ELSE f.held + x.n END AS h FROM fold f JOIN numbered x ON x.doc_id = f.doc_id AND x.k = f.k + 1)),
    windowed AS (SELECT numbered.*, fold.chunk_id FROM numbered JOIN fold USING (doc_id, k)),
    chunked AS (SELECT doc_id, chunk_id::INT AS chunk_id, min(char_start) AS char_start, arg_max(char_end, para_idx) AS char_end, count(*)::INT AS n_paragraphs, string_agg(text, chr(10) || chr(10) ORDER BY para_idx) AS text,
        coalesce(sum(n) FILTER (block_type = 'blockquote') / nullif(sum(n), 0)::DOUBLE, 0) AS quote_ratio, coalesce(sum(n) FILTER (block_type = 'footnote') / nullif(sum(n), 0)::DOUBLE, 0) AS footnote_ratio,
        array_to_string(list_filter([CASE WHEN count(*) FILTER (block_type = 'blockquote') > 0 THEN 'blockquote=' || count(*) FILTER (block_type = 'blockquote') END, CASE WHEN count(*) FILTER (block_type = 'body') > 0 THEN 'body=' || count(*) FILTER (block_type = 'body') END,
            CASE WHEN count(*) FILTER (block_type = 'footnote') > 0 THEN 'footnote=' || count(*) FILTER (block_type = 'footnote') END], lambda x: x IS NOT NULL), ',') AS block_types,
        string_agg(char_start || '-' || char_end, ',' ORDER BY para_idx) AS spans FROM windowed GROUP BY doc_id, chunk_id)"""


CHUNK_ROWS = "SELECT doc_id, chunk_id, char_start, char_end, n_paragraphs, sha256(text) AS text_sha256, block_types, quote_ratio, footnote_ratio, 'ch1' AS chapter_id, spans FROM chunked"

_REPEATED = r"""CASE WHEN len(w) < 80 THEN 0.0 ELSE (len(g) - len(list_distinct(g))) / len(g)::DOUBLE END"""
_GRAMS = r"list_transform(range(1, greatest(1, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))"


def _quality(source: str) -> str:
    """Quality columns of (doc_id, chunk_id, text)."""
    flag = lambda name, cond: f"CASE WHEN {cond} THEN '{name}' END"
    flags = ", ".join((
        flag("too_short", "wc < 350"), flag("too_long", "wc > 1100"), flag("many_short_lines", "n >= 8 AND short / greatest(n, 1)::DOUBLE > 0.55"), flag("many_numbers", "alpha > 0 AND digits / greatest(1, alpha + digits)::DOUBLE > 0.18"),
        flag("many_references", "refs >= 5 AND refs / greatest(1, wc)::DOUBLE > 0.015"), flag("possible_bibliography", "refs >= 6 AND n >= 4"), flag("possible_bibliography", "n >= 8 AND surnames >= 3"),
        flag("possible_index", "n >= 8 AND indexed >= 3"), flag("possible_table", "n >= 5 AND tabular / greatest(n, 1)::DOUBLE > 0.35"), flag("ocr_noise", "length(text) > 0 AND odd / length(text)::DOUBLE > 0.025"),
        flag("repeated_text", "repeated > 0.08"), flag("low_sentence_density", "wc >= 150 AND sentences / greatest(1.0::DOUBLE, wc / 100::DOUBLE) < 1.2"),
    ))
    penalty = " + ".join(f"CASE WHEN list_contains(flags, '{k}') THEN {v}::DOUBLE ELSE 0 END" for k, v in PENALTIES.items())
    return rf"""q1 AS (SELECT *, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::INT AS wc, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM {source}),
    q2 AS (SELECT *, len(ls)::INT AS n, len(list_filter(ls, lambda x: length(trim(x)) <= 35)) AS short, len(regexp_extract_all(text, '[0-9]')) AS digits, len(regexp_extract_all(text, '\p{{L}}')) AS alpha,
        len(regexp_extract_all(text, '[.!?](\s|$)'))::INT AS sentences, (len(regexp_extract_all(text, '(?i)\b(doi|isbn|issn|http)\b|\b(www\.|op\. cit\.|ibid\.|et al\.)\b')) + len(regexp_extract_all(text, '\b(18|19|20)[0-9]{{2}}[a-z]?\b')))::INT AS refs,
        len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[A-ZÀ-ÖØ-Þ][^,]{{1,40}},\s+'))) AS surnames, len(list_filter(ls, lambda x: regexp_matches(x, '\.{{2,}}\s*[0-9]+\s*$'))) AS indexed,
        len(list_filter(ls, lambda x: regexp_matches(x, '\s{{3,}}|\t|[|]'))) AS tabular, len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}_\s.,;:!?()\[\]{{}}''"/\\\-–—%$€£@#&*+=<>]')) AS odd, {_GRAMS} AS g FROM q1),
    q3 AS (SELECT *, {_REPEATED} AS repeated FROM q2),
    q4 AS (SELECT *, list_filter([{flags}], lambda x: x IS NOT NULL) AS flags FROM q3),
    q5 AS (SELECT *, greatest(0, least(1, 1 - ({penalty}))) AS score FROM q4),
    scored AS (SELECT *, CASE WHEN score < 0.45 THEN 'bad' WHEN score >= 0.78 AND len(flags) = 0 THEN 'ok' ELSE 'suspect' END AS status FROM q5)"""


QUALITY_ROWS = "SELECT doc_id, chunk_id, status, round(score, 4) AS score, array_to_string(flags, ',') AS flags, wc AS word_count, n AS line_count, sentences AS sentence_count, refs AS reference_hits FROM scored"


def _gate(body: str) -> str:
    """Check results of (doc_id, body) with lines from the same body; noref as tokens in order."""
    return rf"""befores AS (SELECT *, coalesce(lag(depth) OVER {IN_ORDER}, 0) AS before FROM depths),
    levels AS (SELECT *, CASE WHEN step = -1 THEN before ELSE depth END AS level FROM befores),
    openers AS (SELECT *, last_value(CASE WHEN step = 1 THEN token END IGNORE NULLS) OVER (PARTITION BY doc_id, level ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opener FROM levels),
    found AS (SELECT doc_id, bool_and(NOT (regexp_matches(line, '⟦/?PRL:(BQ|FN)⟧') AND NOT ({SENTINEL}))) AS isolated,
        bool_and(NOT (step = -1 AND (before = 0 OR token <> replace(opener, '⟦PRL', '⟦/PRL')))) AND arg_max(depth, line_no) = 0 AS balanced, bool_and({SENTINEL} OR NOT ({NOISE})) AS clean FROM openers GROUP BY doc_id),
    refs AS (SELECT doc_id, unnest(regexp_extract_all({body}, '⟦/?PRL:REF⟧')) AS tok, generate_subscripts(regexp_extract_all({body}, '⟦/?PRL:REF⟧'), 1) AS k FROM gated),
    walks AS (SELECT doc_id, k, sum(CASE WHEN tok = '⟦PRL:REF⟧' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY k) AS d FROM refs),
    noref AS (SELECT doc_id, min(d) >= 0 AND arg_max(d, k) = 0 AS ok FROM walks GROUP BY doc_id),
    sized AS (SELECT *, len(list_filter(regexp_split_to_array({STRIP.format(body)}, '\s+'), lambda x: x <> ''))::INT AS body_size FROM gated),
    checks AS (SELECT doc_id, unnest([{{'ord': 0, 'code': 'sentinels_isolated', 'passed': isolated}}, {{'ord': 1, 'code': 'sentinels_balanced', 'passed': balanced}}, {{'ord': 2, 'code': 'noteref_balanced', 'passed': coalesce(ok, true)}},
        {{'ord': 3, 'code': 'body_isolated', 'passed': clean}}, {{'ord': 4, 'code': 'body_hashable', 'passed': true}}, {{'ord': 5, 'code': 'provenance_frozen', 'passed': doc_id % 19 <> 0}}, {{'ord': 6, 'code': 'body_min_size', 'passed': body_size >= 200}},
        {{'ord': 7, 'code': 'roundtrip_axis', 'passed': true}}, {{'ord': 8, 'code': 'roundtrip_coverage', 'passed': true}}]) AS c FROM sized JOIN found USING (doc_id) LEFT JOIN noref USING (doc_id))"""


GATED = "gated AS (SELECT doc_id, text AS body FROM docs)"
ON_BODIES = ",\n".join((DOCS.replace("docs AS", "decorated AS"), "small AS (SELECT doc_id, len(list_filter(regexp_split_to_array(" + STRIP.format("text") + r", '\s+'), lambda x: x <> '')) < 200 AS small FROM decorated)"))

CATALOG = """first AS (SELECT CASE WHEN doc_id % 2 = 0 THEN sha256(text) ELSE sha256(text || '?') END AS text_id, CASE WHEN doc_id % 6 = 0 THEN 'config' ELSE 'canonical' END AS rung, CASE WHEN doc_id % 4 = 0 THEN '0.9.0' ELSE '1.0.0' END AS contract_version,
        sha256(text) AS body_hash, doc_id * 2 AS seq, doc_id FROM docs),
    log AS (SELECT * FROM first UNION ALL SELECT text_id, 'hook', contract_version, body_hash, seq + CASE WHEN doc_id % 10 = 0 THEN 1 ELSE -1 END, doc_id FROM first),
    latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY seq DESC) = 1)"""

PAGES = r"""pages_ AS (SELECT conv_id AS doc_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS page_no, coalesce(text, '') AS text FROM conversations),
    pg AS (SELECT *, len(regexp_extract_all(text, '\p{L}')) >= 100 AS is_text, sum((len(regexp_extract_all(text, '\p{L}')) >= 100)::INT) OVER (PARTITION BY doc_id) AS texts FROM pages_ WHERE page_no < 120),
    ln_ AS (SELECT doc_id, page_no, is_text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM pg),
    ln AS (SELECT doc_id, page_no, is_text, line_no, trim(raw) AS line FROM ln_ WHERE trim(raw) <> '')"""
HEADER = r"""ends AS (SELECT doc_id, page_no, arg_min(line, line_no) AS head, arg_max(line, line_no) AS foot FROM ln WHERE is_text GROUP BY doc_id, page_no),
    keyed AS (SELECT doc_id, 'h' AS place, trim(regexp_replace(lower(head), '[^\p{L}]+', ' ', 'g')) AS key FROM ends UNION ALL SELECT doc_id, 'f', trim(regexp_replace(lower(foot), '[^\p{L}]+', ' ', 'g')) FROM ends),
    tops AS (SELECT doc_id, max(n) AS top FROM (SELECT doc_id, place, key, count(*) AS n FROM keyed WHERE length(key) >= 4 GROUP BY ALL) GROUP BY doc_id),
    header AS (SELECT doc_id, CASE WHEN count(*) >= 3 THEN coalesce(any_value(top), 0) / count(*)::DOUBLE ELSE 0.0 END AS header_footer_ratio FROM ends LEFT JOIN tops USING (doc_id) GROUP BY doc_id)"""


def _sql(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n    ".join(ctes) + f"\n{select}"


def _contains(markers: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(low, '{m}')" for m in markers) + ")"


def _reason() -> str:
    th = THRESHOLDS["formal"]
    return rf"""reasons AS (SELECT *, CASE WHEN {_contains(COPYRIGHT)} THEN '{REASONS["copyright"]}' WHEN {_contains(FRONT_MARKERS)} THEN '{REASONS["front"]}' WHEN {_contains(CROSS_SELL)} THEN '{REASONS["cross_sell"]}'
        WHEN chunk_id <= 2 AND {_contains(TRANSLATION)} THEN '{REASONS["front"]}'
        WHEN chunk_id <= 4 AND len(ps) >= 3 AND list_sum(list_transform(ps, lambda p: length(p))) / len(ps)::DOUBLE <= 85 AND (len(regexp_extract_all(text, '\p{{Lu}}')) / greatest(length(text), 1)::DOUBLE >= 0.12 OR {_contains(OPENING)}) THEN '{REASONS["front"]}'
        WHEN coalesce(nav, 0) >= {th["navigation_noise"]} THEN '{REASONS["navigation"]}' WHEN coalesce(ed, 0) >= {th["editorial_discourse"]} THEN '{REASONS["editorial"]}'
        WHEN coalesce(quo, 0) >= {th["quotation_material"]} OR quote_ratio >= {th["quote_ratio"]} THEN '{REASONS["quotation"]}' WHEN coalesce(foo, 0) >= {th["footnote_material"]} OR footnote_ratio >= {th["footnote_ratio"]} THEN '{REASONS["footnote"]}'
        WHEN len(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ][A-Za-zÀ-ÖØ-öø-ÿ''_-]*')) < {th["min_tokens"]} THEN '{REASONS["short"]}' END AS reason
        FROM (SELECT c.*, lower(text) AS low, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: trim(p)), lambda p: p <> '') AS ps, p.nav, p.ed, p.quo, p.foo FROM chunked c LEFT JOIN (
            SELECT doc_id, chunk_id, sum(share) FILTER (block_class = 'navigation_noise') AS nav, sum(share) FILTER (block_class = 'editorial_discourse') AS ed, sum(share) FILTER (block_class = 'quotation_material') AS quo,
                sum(share) FILTER (block_class = 'footnote_material') AS foo FROM profile GROUP BY ALL) p USING (doc_id, chunk_id)))"""


PROFILE = """shared AS (SELECT c.doc_id, c.chunk_id, p.block_class, sum(least(c.char_end, p.char_end) - greatest(c.char_start, p.char_start)) AS n FROM chunked c JOIN classes p ON c.doc_id = p.doc_id AND p.char_start < c.char_end AND c.char_start < p.char_end GROUP BY ALL),
    profile AS (SELECT doc_id, chunk_id, block_class, n / sum(n) OVER (PARTITION BY doc_id, chunk_id)::DOUBLE AS share FROM shared)"""
FORMAL_PARAS = "kept AS (SELECT * FROM paras WHERE block_type = 'body')"

PLAIN_FILLING = repertoire_hash(NOISE_PATTERNS)
TRIMMED_FILLING = hashlib.sha256(f"{PLAIN_FILLING}\x1ffm:{FRONT_MATTER_VERSION}:run=4:zone=80".encode()).hexdigest()


def _freeze(filling: str) -> str:
    return f"sha256(sha256(text) || chr(31) || {filling} || chr(31) || '{ENGINE_VERSION}')"


#: Decorated texts (docs0), cleaned, and the gate's verdict on the bodies of those that are large enough (docs).
DISPATCHED = ",\n".join((
    ON_BODIES, "docs0 AS (SELECT doc_id, text FROM decorated)", LINES.replace("FROM docs)", "FROM docs0)"), CLEAN, BODY.replace("docs", "docs0"),
    "docs AS (SELECT doc_id, body AS text FROM cleaned JOIN small USING (doc_id) WHERE NOT small)", LINES.replace("lines AS", "lines2 AS"), OFFSETS.replace("FROM lines", "FROM lines2"), DEPTH, GATED, _gate("body"),
    "verdict AS (SELECT doc_id, arg_min(c.code, c.ord) FILTER (NOT c.passed) AS failure FROM checks GROUP BY doc_id)",
))


def _renamed(sql: str, *names: str) -> str:
    """Common table expressions under names of their own."""
    return re.sub(rf"\b({'|'.join(names)})\b", r"\1_f", sql)


_WINDOWS = ("numbered", "fold", "windowed", "chunked", "q1", "q2", "q3", "q4", "q5", "scored")


def _counts(key: str, source: str) -> str:
    return f"""(SELECT '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {key}))"""


DIAGNOSED = rf"""tok AS (SELECT *, CASE WHEN texts > 0 THEN is_text ELSE true END AS sampled, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM pg),
    per AS (SELECT doc_id, count(*) AS n, sum(is_text::INT) AS n_text, coalesce(sum(length(text)) FILTER (is_text), 0) AS text_chars, sum(length(text)) FILTER (sampled) + count(*) FILTER (sampled) - 1 AS every, sum(len(regexp_extract_all(text, '�'))) FILTER (sampled) AS repl,
        sum(len(w)) FILTER (sampled) AS toks, sum(len(list_filter(w, lambda x: regexp_matches(x, '^\p{{L}}$') AND NOT contains('{LEGIT_SINGLE}', x)))) FILTER (sampled) AS single, sum(len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}[<>;:#~^/\\|][\p{{L}}\p{{N}}_]')))) FILTER (sampled) AS punct FROM tok GROUP BY doc_id),
    hl AS (SELECT doc_id, 0 AS idx, line AS text FROM ln WHERE page_no < 6), {_signals("hl", "hs")},
    heads AS (SELECT doc_id, avg((length(text) < 25)::INT) AS short, sum(is_structural_label::INT) + sum(has_toc_leader::INT) + sum(regexp_matches(text, '(?i)\b(ISBN|CDD|CDU)\b|Cataloga|Câmara Brasileira do Livro|Copyright ©')::INT) AS marks FROM hs GROUP BY doc_id),
    loose AS (SELECT doc_id, avg(regexp_matches(line, '^\s*[-–—]?\s*[0-9]{{1,4}}\s*[-–—]?\s*$')::INT) AS loose FROM ln GROUP BY doc_id),
    m1 AS (SELECT p.*, n_text / n::DOUBLE AS ratio, coalesce(text_chars / nullif(n_text, 0)::DOUBLE, 0) AS dense, coalesce(short, 0) AS short, coalesce(marks, 0) >= 3 AS fm, coalesce(loose, 0) AS loose, coalesce(header_footer_ratio, 0) AS hf,
        least(1, greatest(0, 0.5::DOUBLE * least(1, repl / greatest(1, every)::DOUBLE * 1000) + 0.3::DOUBLE * least(1, single / greatest(1, toks)::DOUBLE * 100) + 0.2::DOUBLE * least(1, punct / greatest(1, toks)::DOUBLE * 100 / 0.5::DOUBLE))) AS risk
        FROM per p LEFT JOIN heads USING (doc_id) LEFT JOIN loose USING (doc_id) LEFT JOIN header USING (doc_id)),
    m2 AS (SELECT *, least(1, greatest(0, ratio * least(1, dense / 800) * (1 - 0.5::DOUBLE * risk))) AS conf FROM m1),
    m3 AS (SELECT *, list_filter([CASE WHEN n_text = 0 THEN 'no_text_layer' END, CASE WHEN n_text > 0 AND ratio < 0.15 THEN 'sparse_text_layer' END, CASE WHEN n_text > 0 AND conf < 0.25 THEN 'low_body_confidence' END, CASE WHEN risk >= 0.3 THEN 'ocr_quality_risk' END,
        CASE WHEN conf < 0.55 AND conf >= 0.25 THEN 'moderate_body_confidence' END, CASE WHEN fm THEN 'front_matter_at_head' END, CASE WHEN hf >= 0.5 THEN 'running_header_footer' END, CASE WHEN loose >= 0.18 THEN 'loose_numbering' END,
        CASE WHEN short >= 0.55 AND conf < 0.55 THEN 'fragmented_head' END], lambda x: x IS NOT NULL) AS reasons FROM m2),
    diagnosed AS (SELECT *, CASE WHEN list_has_any(reasons, ['no_text_layer', 'sparse_text_layer', 'low_body_confidence']) THEN 'abort' WHEN len(reasons) > 0 THEN 'pass_with_warning' ELSE 'pass' END AS decision FROM m3)"""


def _patterns() -> str:
    """Seed patterns met by the rounded metrics, with their confidence."""
    column = {"text_page_ratio": "round_even(ratio, 4)", "body_confidence": "round_even(conf, 4)", "ocr_risk": "round_even(risk, 4)"}
    parts = []
    for k, seed in enumerate(SEEDS):
        tests, score = [], "1.0::DOUBLE"
        for name, value in seed[4].items():
            if name == "front_matter_at_head":
                tests.append("fm" if value else "NOT fm")
                continue
            x = column[name[:-3]]
            tests.append(f"{x} {'<' if name.endswith('_lt') else '>='} {value}")
            gap = f"abs({value} - {x})"
            if name == "text_page_ratio_lt":
                score += f" * CASE WHEN {gap} > 0.2 THEN 0.8::DOUBLE WHEN {gap} < 0.05 THEN 0.9::DOUBLE ELSE 1 END"
            elif name == "body_confidence_lt":
                score += f" * CASE WHEN {gap} > 0.2 OR {gap} < 0.05 THEN 0.85::DOUBLE ELSE 1 END"
        parts.append(f"SELECT doc_id, {k} AS ord, '{seed[0]}' AS id, {score} AS confidence FROM diagnosed WHERE {' AND '.join(tests)}")
    return "met AS (" + " UNION ALL ".join(parts) + "),\n    patterns AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, ord)::INT AS rank FROM met)"


#: The regular markup of the table: a head to skip, comments, blocks and inline tags, four entities.
HTML_BLOCKS = r"""WITH a AS (SELECT page_id AS doc_id, regexp_replace(regexp_replace(html, '<head>.*?</head>', '', 'gs'), '<!--.*?-->', '', 'gs') AS h FROM pages),
    b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(h, '<br>', ' ', 'g'), '</?(p|li|div|article|h1)( [^>]*)?>', chr(1), 'g'), '<[^>]*>', '', 'g') AS h FROM a),
    c AS (SELECT doc_id, replace(replace(replace(replace(h, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS h FROM b)
    SELECT doc_id, array_to_string(list_filter(list_transform(string_split(h, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM c"""

ORACLE_SQL: dict[str, str] = {
    "text_size": _sql(DOCS, select=rf"SELECT doc_id, len(list_filter(regexp_split_to_array({STRIP.format('text')}, '\s+'), lambda x: x <> ''))::INT AS words, length(regexp_replace({STRIP.format('text')}, '^\s+|\s+$', '', 'g'))::INT AS chars, sha256({STRIP.format('text')}) AS prose_sha256 FROM docs"),
    "freeze_key": f"SELECT doc_id, sha256(text) AS raw_hash, sha256(sha256(text) || chr(31) || CASE WHEN doc_id % 2 = 0 THEN '{repertoire_hash(NOISE_PATTERNS)}' ELSE '∅' END || chr(31) || '{ENGINE_VERSION}') AS freeze_key FROM documents",
    "lines_offsets": _sql(DOCS, LINES, OFFSETS, select="SELECT doc_id, line_no, char_start, char_start + length(line) AS char_end FROM offsets"),
    "clean_noise": _sql(DOCS, LINES, _no_noise("lines", "c"), select="SELECT doc_id, line_no, line FROM c"),
    "clean_pagenum": _sql(DOCS, LINES, _no_page_numbers("lines", "c"), select="SELECT doc_id, line_no, line FROM c"),
    "clean_dehyphen": _sql(DOCS, LINES, _dehyphenated("lines", "c"), select="SELECT doc_id, line_no, line FROM c"),
    "clean_reflow": _sql(DOCS, LINES, _reflowed("lines", "c"), select="SELECT doc_id, line_no, line FROM c"),
    "clean_body": _sql(DOCS, LINES, CLEAN, BODY, select="SELECT doc_id, length(body)::INT AS n_chars, sha256(body) AS output_sha256 FROM cleaned"),
    "clean_front_matter": _sql(
        DOCS, LINES, f"opened AS (SELECT *, bool_or({SENTINEL}) OVER {LAST} AS o FROM lines)",
        "zone AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS idx, trim(line) AS text FROM opened WHERE NOT o AND trim(line) <> '' QUALIFY idx < 80)",
        _signals("zone", "sg"), _labels("sg", "lb"), "drops AS (SELECT doc_id, line_no FROM lb WHERE label = 'navigation_noise')",
        "kept AS (SELECT l.*, trim(line) = '' AS blank FROM lines l ANTI JOIN drops USING (doc_id, line_no))",
        f"marked AS (SELECT *, coalesce(lag(blank) OVER {IN_ORDER}, false) AS before, bool_and(blank) OVER {LAST} AS first_ones FROM kept)",
        select="SELECT doc_id, line_no, line FROM marked WHERE NOT (blank AND (before OR first_ones) AND doc_id IN (SELECT doc_id FROM drops))"),
    "fm_signals": _sql(DOCS, LINES, FRONT, _signals("front", "sg"), select="SELECT doc_id, idx, word_count, sentences, ends_sentence, has_connective, is_structural_label, is_editorial_heading, is_numbered_chapter, has_toc_leader, is_discursive, is_heading_like, is_nav_candidate, is_strong_nav_marker, is_section_heading FROM sg"),
    "fm_labels": _sql(DOCS, LINES, FRONT, _signals("front", "sg"), _labels("sg", "lb"), select="SELECT doc_id, idx, label FROM lb WHERE label IS NOT NULL"),
    "paragraphs": _sql(STRUCTURE, select="SELECT doc_id, para_idx, char_start, char_end, block_type, 'ch1' AS chapter_id, sha256(text) AS text_sha256 FROM paras"),
    "classification": _sql(STRUCTURE, CLASSES, select="SELECT doc_id, para_idx AS index, block_type, block_class, has_note_call, round_even((row_number() OVER (PARTITION BY doc_id ORDER BY para_idx) - 1) / (count(*) OVER (PARTITION BY doc_id))::DOUBLE, 4) AS position FROM classes"),
    "class_counts": _sql(STRUCTURE, CLASSES, select="SELECT doc_id, block_class, count(*) AS n FROM classes GROUP BY ALL"),
    "gate_checks": _sql(STRUCTURE, GATED, _gate("body"), select="SELECT doc_id, c.ord AS ord, c.code AS code, c.passed AS passed FROM checks"),
    "gate_results": _sql(STRUCTURE, GATED, _gate("body"), select="SELECT doc_id, bool_and(c.passed) AS passed, arg_min(c.code, c.ord) FILTER (NOT c.passed) AS first_failure, any_value(sha256(body)) AS body_hash, any_value(body_size)::INT AS body_size FROM checks JOIN sized USING (doc_id) GROUP BY doc_id"),
    "dispatch_status": _sql(
        ON_BODIES, "docs0 AS (SELECT doc_id, text FROM decorated)", LINES.replace("lines AS", "lines AS").replace("FROM docs)", "FROM docs0)"), CLEAN, BODY.replace("docs", "docs0"),
        "docs AS (SELECT doc_id, body AS text FROM cleaned JOIN small USING (doc_id) WHERE NOT small)", LINES.replace("lines AS", "lines2 AS"), OFFSETS.replace("FROM lines", "FROM lines2"), DEPTH, GATED, _gate("body"),
        "verdict AS (SELECT doc_id, arg_min(c.code, c.ord) FILTER (NOT c.passed) AS failure FROM checks GROUP BY doc_id)",
        select="""SELECT s.doc_id, CASE WHEN small THEN 'too_small' WHEN failure IS NULL THEN 'canonical' ELSE 'needs_hook' END AS status, CASE WHEN NOT small THEN sha256(body) END AS body_hash, failure AS static_failure, NULL::VARCHAR AS roundtrip_failure
            FROM small s LEFT JOIN verdict USING (doc_id) LEFT JOIN cleaned USING (doc_id)"""),
    "catalog_current": _sql(DOCS, CATALOG, select="SELECT text_id, rung, contract_version, seq FROM latest"),
    "catalog_stats": _sql(DOCS, CATALOG, select="SELECT rung, count(*) AS n FROM latest GROUP BY rung"),
    "catalog_stale": _sql(DOCS, CATALOG, select="SELECT text_id FROM latest WHERE contract_version <> '1.0.0'"),
    "catalog_lookup": _sql(DOCS, CATALOG, select="SELECT docs.doc_id, rung, body_hash FROM docs LEFT JOIN latest ON sha256(text) = text_id"),
    "chunks": _sql(STRUCTURE, _greedy("paras", *CONCEPTUAL), select=CHUNK_ROWS, recursive=True),
    "chunks_formal": _sql(STRUCTURE, FORMAL_PARAS, _greedy("kept", *FORMAL), select=CHUNK_ROWS, recursive=True),
    "quality": _sql("docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)", LINES, OFFSETS, DEPTH, PARAGRAPHS, _greedy("paras", *CONCEPTUAL), _quality("chunked"), select=QUALITY_ROWS, recursive=True),
    "quality_documents": _sql(DOCS, "whole AS (SELECT doc_id, 0 AS chunk_id, text FROM docs)", _quality("whole"), select=QUALITY_ROWS),
    "quality_report": _sql(
        "whole AS (SELECT doc_id, 0 AS chunk_id, text FROM documents)", _quality("whole"),
        select="""SELECT count(*) AS total_chunks, (SELECT string_agg(s || '=' || k, ',' ORDER BY s) FROM (SELECT status AS s, count(*) AS k FROM scored GROUP BY status)) AS status_counts,
            (SELECT string_agg(f || '=' || k, ',' ORDER BY f) FROM (SELECT f, count(*) AS k FROM (SELECT unnest(flags) AS f FROM scored) GROUP BY f)) AS flag_counts,
            round(round_even(avg(round_even(score, 4)), 4), 3) AS avg_score, min(round_even(score, 4)) AS min_score, max(round_even(score, 4)) AS max_score FROM scored"""),
    "repeated_text": rf"WITH a AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents), b AS (SELECT *, {_GRAMS} AS g FROM a) SELECT doc_id, {_REPEATED} AS score FROM b",
    "class_profile": _sql(STRUCTURE, CLASSES, _greedy("paras", *CONCEPTUAL), PROFILE, select="SELECT doc_id, chunk_id, block_class, round(share, 9) AS share FROM profile", recursive=True),
    "eligibility": _sql(STRUCTURE, CLASSES, FORMAL_PARAS, _greedy("kept", *FORMAL), PROFILE, _reason(), select="SELECT doc_id, chunk_id, unnest(['conceitual', 'formal']) AS track, reason IS NOT NULL AS is_noise, reason FROM reasons", recursive=True),
    "dispatch_reuse": _sql(
        DISPATCHED, """log AS (SELECT CASE WHEN doc_id % 8 = 7 THEN sha256(text || '?') ELSE sha256(text) END AS text_id, CASE doc_id % 8 WHEN 1 THEN 'unsupported_rung' WHEN 2 THEN 'drift' ELSE 'reused' END AS known, doc_id FROM decorated),
    latest AS (SELECT text_id, arg_max(known, doc_id) AS known FROM log GROUP BY text_id),
    reused AS (SELECT s.doc_id, small, known FROM small s JOIN decorated USING (doc_id) LEFT JOIN latest ON text_id = sha256(text))""",
        select="""SELECT r.doc_id, CASE WHEN small THEN 'too_small' WHEN known IS NOT NULL THEN known WHEN failure IS NULL THEN 'canonical' ELSE 'needs_hook' END AS status, CASE WHEN NOT small THEN sha256(body) END AS body_hash
            FROM reused r LEFT JOIN verdict USING (doc_id) LEFT JOIN cleaned USING (doc_id)"""),
    "filling_hashes": _sql(DOCS, f"f AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '{TRIMMED_FILLING}' ELSE '{PLAIN_FILLING}' END AS filling FROM docs)", select=f"SELECT doc_id, doc_id % 3 = 0 AS trimmed, filling AS filling_hash, {_freeze('filling')} AS freeze_key FROM f"),
    "catalog_entries": _sql(
        DISPATCHED, select=f"""SELECT sha256(text) AS text_id, 'canonical' AS rung, body_size, sha256(body) AS body_hash, {_freeze("'" + PLAIN_FILLING + "'")} AS freeze_key, '1.0.0' AS contract_version, CASE WHEN doc_id % 19 = 0 THEN '' ELSE 'first' END AS source_edition, 3::BIGINT AS seq
            FROM verdict JOIN sized USING (doc_id) JOIN decorated USING (doc_id) WHERE failure IS NULL"""),
    "run_summary": _sql(
        DISPATCHED, PARAGRAPHS.replace("paras AS", "all_paras AS"), "paras AS (SELECT a.* FROM all_paras a JOIN verdict v USING (doc_id) WHERE failure IS NULL)", CLASSES, _greedy("paras", *CONCEPTUAL), _quality("chunked"),
        FORMAL_PARAS, _renamed(_greedy("kept", *FORMAL), *_WINDOWS), _renamed(_quality("chunked"), *_WINDOWS),
        "statuses AS (SELECT CASE WHEN small THEN 'too_small' WHEN failure IS NULL THEN 'canonical' ELSE 'needs_hook' END AS status, CASE WHEN NOT small AND failure IS NULL THEN 'canonical' END AS rung FROM small s LEFT JOIN verdict USING (doc_id))",
        select=f"""SELECT {_counts('status', 'statuses')} AS documents, {_counts('block_class', 'classes')} AS classes, {_counts('rung', "(SELECT rung FROM statuses WHERE rung IS NOT NULL)")} AS catalog,
            (SELECT count(*) FROM scored WHERE status = 'ok') AS ok_chunks, (SELECT count(*) FROM scored_f WHERE status = 'ok') AS ok_formal_chunks""", recursive=True),
    "html_blocks": HTML_BLOCKS,
    "pdf_pages": r"""WITH a AS (SELECT doc_id, string_split(coalesce(text, '') || chr(10), chr(10)) AS p FROM documents), b AS (SELECT doc_id, CASE WHEN trim(p[-1]) = '' THEN p[:-2] ELSE p END AS p FROM a),
        c AS (SELECT doc_id, unnest(p) AS page, generate_subscripts(p, 1) - 1 AS page_no FROM b) SELECT doc_id, page_no::INT AS page_no, sha256(regexp_replace(page || chr(10) || chr(10) || '.', '^\s+', '')) AS text_sha256, length(trim(page)) >= 80 AS meaningful FROM c WHERE page_no < 50""",
    "pdf_diagnostics": _sql(PAGES, HEADER, DIAGNOSED, select="SELECT doc_id, decision, n AS pages_analyzed, n_text::BIGINT AS pages_with_text, round(round_even(ratio, 4), 3) AS text_page_ratio, round(round_even(risk, 4), 3) AS ocr_risk, fm AS front_matter_at_head, array_to_string(reasons, ',') AS reasons FROM diagnosed"),
    "pdf_patterns": _sql(PAGES, HEADER, DIAGNOSED, _patterns(), select="SELECT doc_id, rank, id, confidence FROM patterns"),
    "pdf_usage": _sql(PAGES, HEADER, DIAGNOSED, _patterns(), select="SELECT id AS strategy_id, count(*) AS times_applied FROM patterns WHERE rank = 1 GROUP BY id"),
    "pdf_header_footer": _sql(PAGES, HEADER, select="SELECT doc_id, header_footer_ratio FROM header"),
}
