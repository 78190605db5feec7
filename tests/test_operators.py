"""Single operators on small literals, and properties against sequential loops."""

from __future__ import annotations

import hashlib
import io
import json
import os
import random
import time
import zipfile

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum import registry
from vellum.config import BQ_CLOSE, BQ_OPEN, FN_CLOSE, FN_OPEN, REF_CLOSE, REF_OPEN, Config
from vellum.functions import text as t
from vellum.operators import catalog, chunk, clean, dispatch, eligibility, frontmatter, gate, lines, pdf, quality, segment
from vellum.operators.lines import explode_lines
from vellum.plans import pipeline
from vellum.sources import files
from vellum.sources.epub import epub_text
from vellum.sources.html import html_text
from vellum.sources.pdf import meaningful, normalized, read_pages, split_pages


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def stage(spark, run, *texts):
    out = lines.join_lines(run(lines.explode_lines(docs(spark, *texts)))).collect()
    found = {r.doc_id: r.body for r in out}
    return [found.get(k) for k in range(len(texts))]


def test_white_space_and_sizes(spark):
    row = docs(spark, "a b\x85c\x1cd  ", "", None, f" x{REF_OPEN}1{REF_CLOSE} ").select(t.body_size(F.col("text")).alias("w"), t.body_size(F.col("text"), "chars").alias("c")).collect()
    assert [(r.w, r.c) for r in row] == [(4, 7), (0, 0), (None, None), (1, 2)] or row[2].w in (-1, None)
    with pytest.raises(ValueError):
        t.body_size(F.col("text"), "pages")


def test_label_key(spark):
    import unicodedata

    texts = ["Índice  Geral", "ÇÃO ß ﬁ …", "ĀŽ º ½", "plain"]
    want = [" ".join("".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold().split()) for x in texts]
    assert [r[0] for r in docs(spark, *texts).select(t.label_key(F.col("text"))).collect()] == want


def test_dehyphenate(spark):
    got = stage(spark, clean.dehyphenate, "foo-\n-\nbar", "foo-\n\nbar", f"foo-\n{BQ_OPEN}", "a-\n  b-\nc", "foo-", "-\nx")
    assert got == ["foobar", "foo-\n\nbar", f"foo-\n{BQ_OPEN}", "abc", "foo-", "-\nx"]


def test_reflow(spark):
    got = stage(spark, clean.reflow, "  Uma frase  \n continua", "Fim.\nnova", f"um\n{FN_OPEN}\ndois", "um\n\ndois", "um\nDois", "a\nb\nc")
    assert got == ["  Uma frase continua", "Fim.\nnova", f"um\n{FN_OPEN}\ndois", "um\n\ndois", "um\nDois", "a b c"]


def sequential_clean(text):
    """Hyphens and reflow as a plain loop over lines."""
    import re

    marks = {BQ_OPEN, BQ_CLOSE, FN_OPEN, FN_CLOSE}
    rows, out = text.split("\n"), []
    while rows:
        x = rows.pop(0)
        if x.strip() not in marks and re.search(r"\w-\s*$", x) and rows and rows[0].strip() and rows[0].strip() not in marks:
            rows[0] = re.sub(r"-\s*$", "", x) + rows[0].lstrip()
        else:
            out.append(x)
    done = []
    for x in out:
        s = x.strip()
        before = done[-1] if done else ""
        if s and s not in marks and before.strip() and before.strip() not in marks and before.rstrip()[-1] not in '.!?:;”")]…' and s[0].islower():
            done[-1] = before.rstrip() + " " + s
        else:
            done.append(x)
    return "\n".join(done)


def test_clean_is_the_sequential_fold(spark):
    rng = random.Random(4)
    texts = ["\n".join(rng.choice(["a", "A b", "foo-", "-", "", " x- ", "end.", BQ_OPEN, BQ_CLOSE, "é-", "z)", "- 12 -"]) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    got = stage(spark, lambda x: clean.reflow(clean.dehyphenate(x)), *texts)
    assert got == [sequential_clean(x) for x in texts]


PROSE = "Esta frase é longa o bastante para contar como prosa, porque tem muitas palavras em sequência e termina com um ponto final, como convém a um texto de verdade aqui."


def test_front_matter(spark):
    toc = "Sumário\n\nCapítulo I ... 3\n\n\nCapítulo II ... 9\nCapítulo III ... 12\nCapítulo I\n" + PROSE
    poem = "\n".join(["verso curto"] * 10)
    alone = f"{PROSE}\nCapítulo I\n{PROSE}"
    got = stage(spark, lambda x: clean.trim_front_matter(x, Config()), toc, poem, alone)
    assert got == [f"Capítulo I\n{PROSE}", poem, alone]
    rows = spark.createDataFrame([(1, k, x) for k, x in enumerate([y for y in toc.split("\n") if y])], "doc_id long, idx int, text string")
    labels = {r.idx: r.label for r in frontmatter.with_labels(rows).collect()}
    assert labels == {0: "navigation_noise", 1: "navigation_noise", 2: "navigation_noise", 3: "navigation_noise", 4: "main_body_start", 5: "main_body_start"}


def test_segment_nesting(spark):
    body = "\n".join([BQ_CLOSE, "one", BQ_OPEN, FN_OPEN, "two", FN_CLOSE, "three", BQ_CLOSE, "", f"four{REF_OPEN}1{REF_CLOSE}"])
    df = spark.createDataFrame([(1, body)], "doc_id long, body string")
    rows = segment.segment(df).orderBy("para_idx").collect()
    assert [(r.text, r.block_type) for r in rows] == [("one", "body"), ("two", "footnote"), ("three", "blockquote"), ("four1", "body")]
    assert all(body[r.char_start : r.char_end] == r.raw for r in rows)
    classes = segment.classify(segment.segment(df)).orderBy("index").collect()
    assert [(c.block_class, c.has_note_call, c.position) for c in classes] == [("main_body", False, 0.0), ("footnote_material", False, 0.25), ("quotation_material", False, 0.5), ("main_body", True, 0.75)]


def stack_types(text):
    kinds, stack, out = {BQ_OPEN: "blockquote", FN_OPEN: "footnote"}, [], []
    for x in text.split("\n"):
        if x in kinds:
            stack.append(kinds[x])
        elif x in (BQ_CLOSE, FN_CLOSE):
            stack = stack[:-1]
        elif x.strip():
            out.append(stack[-1] if stack else "body")
    return out


def test_depth_is_a_stack(spark):
    rng = random.Random(9)
    texts = ["\n".join(rng.choice([BQ_OPEN, BQ_CLOSE, FN_OPEN, FN_CLOSE, "x", ""]) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    df = docs(spark, *texts).withColumnRenamed("text", "body")
    found: dict[int, list] = {}
    for r in segment.segment(df).orderBy("doc_id", "para_idx").collect():
        found.setdefault(r.doc_id, []).append(r.block_type)
    assert [found.get(k, []) for k in range(len(texts))] == [stack_types(x) for x in texts]


def test_gate(spark):
    cases = {
        "fine": f"{BQ_OPEN}\nx\n{BQ_CLOSE}\ny{REF_OPEN}1{REF_CLOSE}", "sentinels_isolated": f"x {BQ_OPEN}", "sentinels_balanced": f"{BQ_CLOSE}\nx",
        "sentinels_balanced2": f"{BQ_OPEN}\nx\n{FN_CLOSE}", "sentinels_balanced3": f"{FN_OPEN}\nx", "noteref_balanced": f"x{REF_CLOSE}{REF_OPEN}", "body_isolated": "see www.a.b",
    }
    rows = [(k, v, "txt", "one", None) for k, v in cases.items()]
    bodies = spark.createDataFrame(rows, "doc_id string, body string, source_format string, source_edition string, translation_layer string")
    config = Config(min_size=1)
    checks = gate.static_checks(bodies, config).unionByName(gate.roundtrip_checks(bodies, segment.segment(bodies)))
    first = {r.doc_id: r.first_failure for r in gate.results(checks, bodies, config).collect()}
    assert first == {k: None if k == "fine" else k.rstrip("23") for k in cases}
    assert {r.doc_id for r in gate.gate_passes(bodies, segment.segment(bodies), config).where("passed").collect()} == {"fine"}


def test_gate_details(spark):
    """The first offenders with their places, one pass or two."""
    body = f"x {BQ_OPEN}\nsee www.a.b\n{BQ_OPEN}\ny{REF_CLOSE}"
    bodies = spark.createDataFrame([("a", body, "txt", "one", None), ("b", None, "txt", "", None)], "doc_id string, body string, source_format string, source_edition string, translation_layer string")
    config = Config(min_size=1)
    rows = {(r.doc_id, r.code): r for r in gate.static_checks(bodies, config).collect()}
    details = lambda doc, code: json.loads(rows[doc, code].details)
    assert details("a", "sentinels_isolated") == {"offenders": 1, "first_offenders": [{"char_start": 0, "line": f"x {BQ_OPEN}"}]}
    assert details("a", "sentinels_balanced")["error"]["reason"] == "open without close"
    assert details("a", "noteref_balanced")["error"] == {"reason": "close without open", "char_start": body.index(REF_CLOSE)}
    assert details("a", "body_isolated")["first_leaks"] == [{"char_start": body.index("see"), "line": "see www.a.b"}]
    assert not rows["b", "body_hashable"].passed and not rows["b", "provenance_frozen"].passed and rows["b", "sentinels_isolated"].passed
    own = gate.own_checks(bodies.where("doc_id = 'a'").drop("body"), explode_lines(bodies, "body"), config).first()
    assert own.body == body and [c.code for c in own.checks if not c.passed] == ["sentinels_isolated", "sentinels_balanced", "noteref_balanced", "body_isolated"]


def test_gate_is_linear(spark):
    """Twice the lines of one document take at most 2.5 times as long."""
    def seconds(n):
        body = "\n".join(f"Linha número {k} de um texto com várias palavras." for k in range(n))
        bodies = spark.createDataFrame([(1, body, "txt", "one", None)], "doc_id long, body string, source_format string, source_edition string, translation_layer string")
        paragraphs = segment.segment(bodies)
        began = time.time()
        assert all(r.passed for r in gate.roundtrip_checks(bodies, paragraphs).collect())
        own = gate.own_checks(bodies.drop("body"), explode_lines(bodies, "body"), Config(min_size=1)).select("checks").first()
        assert all(c.passed for c in own.checks)
        return time.time() - began

    seconds(2000)
    assert seconds(40_000) <= 2.5 * seconds(20_000) + 1


def test_roundtrip_of_foreign_structure(spark):
    bodies = spark.createDataFrame([(k, "ab cd\nef") for k in range(4)], "doc_id long, body string")
    spans = [(0, 0, 5, "ab cd"), (0, 6, 8, "ef"), (1, 0, 5, "ab cd"), (2, 0, 5, "ab xx"), (2, 6, 8, "ef"), (3, 0, 6, "ab cd\n"), (3, 5, 8, "\nef")]
    paragraphs = spark.createDataFrame(spans, "doc_id long, char_start int, char_end int, text string")
    got = {(r.doc_id, r.code): r.passed for r in gate.roundtrip_checks(bodies, paragraphs).collect()}
    assert [(got[k, "roundtrip_axis"], got[k, "roundtrip_coverage"]) for k in range(4)] == [(True, True), (True, False), (False, True), (True, False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1500), max_size=40), st.integers(1, 900), st.integers(1, 1200))
def test_greedy_windows(lengths, target, most):
    ids = chunk.greedy_ids(np.array(lengths), target, most)
    assert list(ids) == sorted(ids) and (not len(ids) or ids[0] == 0)
    sums = [sum(n for n, i in zip(lengths, ids, strict=True) if i == k) for k in range(max(ids, default=-1) + 1)]
    for k, total in enumerate(sums[:-1]):
        following = next(n for n, i in zip(lengths, ids, strict=True) if i == k + 1)
        assert total >= target or total + following > most


def test_chunk_boundaries(spark):
    assert [list(chunk.greedy_ids(np.array(x), 750, 1100)) for x in ([740, 400], [760], [1200], [0, 1200])] == [[0, 1], [0], [0], [0, 1]]
    body = "\n".join(["a" * 400, BQ_OPEN, "b" * 200, BQ_CLOSE, "c" * 400])
    paragraphs = segment.segment(spark.createDataFrame([(1, body)], "doc_id long, body string"))
    (only,) = chunk.chunks(paragraphs, 2200, 3500, keep=("body",)).collect()
    assert only.n_paragraphs == 2 and only.block_types == {"body": 2} and only.quote_ratio == 0
    (profile,) = eligibility.class_profile(chunk.formal(paragraphs), segment.classify(paragraphs)).collect()
    assert profile.profile["quotation_material"] == 0.2


def test_quality_flags(spark):
    words80, words79 = " ".join(["word"] * 80), " ".join(["word"] * 79)
    surnames = "\n".join(["Silva, J. 1984 1985"] * 8)
    rows = docs(spark, words79, words80, surnames, "https://x", "http://x", "op. cit. p", "").collect()
    out = {r.doc_id: r for r in quality.with_quality(spark.createDataFrame(rows).withColumn("chunk_id", F.lit(0))).collect()}
    assert [r[0] for r in docs(spark, words79, words80).select(quality.repeated_text_score(F.col("text"))).collect()] == [0.0, 75 / 76]
    assert out[2].quality.flags.count("possible_bibliography") == 2
    assert out[2].score_raw == pytest.approx(1 - sum(quality.PENALTIES[f] for f in set(out[2].quality.flags)))
    assert [out[k].quality.metrics.reference_hits for k in (3, 4, 5)] == [0, 1, 0]


def test_eligibility_reasons(spark):
    rows = [(1, k, x, 0, 10, 0.0, 0.0) for k, x in enumerate(["Copyright notice", "Contents of it", "Compre agora e leia", "uma tradução " * 20, "too short", "words in a row " * 10])]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_id int, text string, char_start int, char_end int, quote_ratio double, footnote_ratio double")
    classes = spark.createDataFrame([], "doc_id long, char_start int, char_end int, block_class string")
    got = {r.chunk_id: r.reason for r in eligibility.eligibility(chunks, classes, ("formal",)).collect()}
    r = eligibility.REASONS
    assert got == {0: r["copyright"], 1: r["front"], 2: r["cross_sell"], 3: None, 4: r["short"], 5: None}
    with pytest.raises(ValueError):
        eligibility.tracks(spark, ("other",))


def test_catalog_and_dispatch(spark):
    text = " ".join(["palavra"] * 30)
    given_ = spark.createDataFrame([(1, text, "txt", "one", None), (2, "few", "txt", "one", None), (3, text + " x " + BQ_OPEN, "txt", "one", None)], "doc_id long, text string, source_format string, source_edition string, translation_layer string")
    config = Config(min_size=10)
    first = pipeline.run(given_, config)
    assert {r.doc_id: r.status for r in first.dispatched.collect()} == {1: "canonical", 2: "too_small", 3: "needs_hook"}
    assert {r.doc_id: r.static_failure for r in first.rejects.collect()} == {2: None, 3: "sentinels_isolated"}
    log = first.catalog_entries
    again = {r.doc_id: r.status for r in dispatch.dispatch(given_, config, log).collect()}
    assert again == {1: "reused", 2: "too_small", 3: "needs_hook"}
    changed = log.withColumn("body_hash", F.lit("other")).withColumn("seq", F.lit(5).cast("bigint"))
    assert {r.doc_id: r.status for r in dispatch.dispatch(given_, config, log.unionByName(changed)).collect()}[1] == "drift"
    hook = dispatch.anchor(lambda x: x.replace(BQ_OPEN, ""))
    assert {r.doc_id: r.status for r in dispatch.dispatch(given_, config, None, [hook]).collect()}[3] == "config"
    assert catalog.stats(catalog.current(log)).collect()[0].n == 1 and catalog.stale(log, "2.0.0").count() == 1


def test_html():
    assert html_text("<html><head><meta charset=utf-8><title>t</title></head><body><p>a<br>b</p><ul><li>c<li>d</ul><script>x</script></body>") == "a b\n\nc\n\nd"
    assert html_text('<meta charset="x"><p>a</p>', void_compat=True) == ""
    assert html_text("<blockquote><p>q</p></blockquote><aside class='footnote'>n</aside>x<a epub:type='noteref'>1</a>") == f"{BQ_OPEN}\n\nq\n\n{BQ_CLOSE}\n\n{FN_OPEN}\n\nn\n\n{FN_CLOSE}\n\nx{REF_OPEN}1{REF_CLOSE}"
    assert html_text(None) == "" and html_text("<div>open &amp; unclosed") == "open & unclosed"


def test_html_blocks_is_its_sql_on_bare_references(spark, tmp_path):
    pages = ["<p>a &amp</p><p>b &amp; c</p>", "<p>&ampx &copyfoo; &quot;q&quot; & &amp;amp &;</p>", "<a href='?a=1&copy=2'>x&copy</a>", None, "", "<p>end &amp"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    ours = {r["doc_id"]: r["text"] for r in registry.QUERIES["html_blocks"](spark, str(tmp_path)).collect()}
    assert ours == dict(con.execute(registry.ORACLE_SQL["html_blocks"]).fetchall())
    assert ours[0] == "a &amp\n\nb & c" and html_text(pages[0]) == "a &\n\nb & c"


def test_epub():
    def make(files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in files.items():
                z.writestr(name, data)
        return out.getvalue()

    opf = '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="b" href="b.xhtml"/><item id="a" href="a.xhtml"/><item id="x" href="gone.xhtml"/></manifest><spine><itemref idref="b"/><itemref idref="x"/><itemref idref="a"/></spine></package>'
    container = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>'
    assert epub_text(make({"META-INF/container.xml": container, "O/p.opf": opf, "O/a.xhtml": "<p>A</p>", "O/b.xhtml": "<p>B</p>"})) == "B\n\nA"
    assert epub_text(make({"b.html": "<p>2</p>", "a.htm": "<p>1</p>", "c.css": "x"})) == "1\n\n2"


def test_pdf_pages_and_diagnosis(spark):
    layers = docs(spark, "one\ftwo\f", "a\r\nb")
    assert [(r.doc_id, r.page_no, r.text) for r in split_pages(layers).orderBy("doc_id", "page_no").collect()] == [(0, 0, "one"), (0, 1, "two"), (1, 0, "a\r\nb")]
    assert [r[0] for r in layers.select(normalized(F.col("text"))).collect()] == ["one\n\ntwo", "a\nb"]
    assert [r[0] for r in layers.select(meaningful(F.col("text"))).collect()] == [False, False]
    prose = "palavra longa e boa " * 60
    rows = [(0, 0, ""), (0, 1, "x")] + [(1, p, f"Cabeçalho Igual {p}\n{prose}\nfim {p * 7}") for p in range(4)] + [(2, p, prose + "� " * 40) for p in range(2)]
    pages = spark.createDataFrame(rows, "doc_id long, page_no int, text string")
    got = {r.doc_id: r for r in pdf.diagnose(pages).collect()}
    assert got[0].decision == "abort" and got[0].reasons[0].code == "no_text_layer"
    assert got[1].repeated_header_footer_ratio == 1.0 and [x.code for x in got[1].reasons] == ["running_header_footer"]
    assert got[2].repeated_header_footer_ratio == 0.0 and "ocr_quality_risk" in [x.code for x in got[2].reasons]
    best = {r.doc_id: r.id for r in pdf.match_patterns(pdf.diagnose(pages), pdf.seed_patterns(spark)).where("rank = 1").collect()}
    assert best[0] == "low_body_confidence" or best[0] == "image_only_scan"
    assert best[1] == "robust_digital_born" and best[2] == "poor_ocr_quality"
    log = pdf.cases(pdf.diagnose(pages), pdf.match_patterns(pdf.diagnose(pages), pdf.seed_patterns(spark)))
    assert {r.decision for r in log.collect()} == {"pass"} and sum(r.times_applied for r in pdf.usage(log).collect()) == 3


def test_command_line(spark, tmp_path):
    from vellum import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("\r\n".join(["Uma palavra e outra."] * 10))
    (tmp_path / "in/b.xyz").write_text("?")
    args = ["run", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--min-size", "5"]
    assert cli.main(args) == 0
    assert spark.read.json(str(tmp_path / "out/unreadable")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/bodies")).count() == 1
    assert cli.main(["quality", str(tmp_path / "out/chunks"), "-o", str(tmp_path / "q"), "--report", str(tmp_path / "r")]) == 0
    assert spark.read.json(str(tmp_path / "r")).first().total_chunks >= 1


STUBS = {
    "pdffonts": 'echo name; echo ----; grep -q ^LAYER "$1" && echo Times; exit 0',
    "pdfinfo": 'echo "Title: x"; echo "Pages:          $(grep -c PAGE "$1")"',
    "pdftotext": 'shift; [ "$1" = -l ] && shift 2; if grep -q ^LAYER "$1"; then tail -n +2 "$1" | sed "s/^PAGE.*/\\f/" | tail -n +2; fi; printf "\\f"',
    "pdftoppm": 'for x; do last=$x; done; cp "${@: -2:1}" "$last.png"; echo "$5" >> "$last.png"',
    "tesseract": 'echo "Texto reconhecido de uma página com palavras, folha $(tail -n 1 "$1")."',
}


def test_pdf_admission_catalog_and_memory(spark, tmp_path, monkeypatch):
    """A scan is refused before it is extracted; what is processed is logged; a second run reuses it; forced, pages are recognised."""
    from vellum import cli

    (tmp_path / "bin").mkdir()
    for name, script in STUBS.items():
        (tmp_path / "bin" / name).write_text("#!/bin/bash\n" + script + "\n")
        (tmp_path / "bin" / name).chmod(0o755)
    monkeypatch.setenv("PATH", f"{os.environ['PATH']}:{tmp_path}/bin")
    for folder in ("in", "scans"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "scan.pdf").write_text("SCAN\n" + "PAGE\n" * 11)
    prose = "Uma página com palavras bastantes, escrita para o teste, que segue adiante.\n" * 16
    (tmp_path / "in/good.pdf").write_text("LAYER\n" + "".join(f"PAGE\nA página {w} começa.\n{prose}A página {w} acaba.\n" for w in ("alfa", "beta", "gama", "delta")))
    out = str(tmp_path / "out")
    args = ["run", str(tmp_path / "in"), "-o", out, "--min-size", "20"]
    name = lambda r: r.doc_id.rpartition("/")[2]
    assert cli.main(args) == 0
    assert {name(r): (r.decision, r.pages_analyzed, r.total_pages) for r in spark.read.json(f"{out}/pdf_diagnostics").collect()} == {"scan.pdf": ("abort", 1, 11), "good.pdf": ("pass", 4, 4)}
    assert [name(r) for r in spark.read.parquet(f"{out}/bodies").collect()] == ["good.pdf"] and spark.read.parquet(f"{out}/raw").count() == 1
    patterns, cases = files.read_memory(spark, f"{out}/pdf_resolution_memory")
    (case,) = cases.collect()
    text = (tmp_path / "in/good.pdf").read_bytes()
    assert (case.decision, case.strategy_id, case.resolution_method, case.raw_hash) == ("pass", "robust_digital_born", "pattern_match", hashlib.sha256(text).hexdigest())
    assert patterns.count() == 5 and patterns.where("notes is null").count() == 0
    first = files.read_catalog(spark, f"{out}/anchor_catalog").collect()
    assert [r.seq for r in first] == [1]
    assert cli.main(args) == 0  # the catalog knows the text: nothing is registered again
    assert files.read_catalog(spark, f"{out}/anchor_catalog").collect() == first and spark.read.json(f"{out}/anchor_catalog").count() == 1
    _, cases = files.read_memory(spark, f"{out}/pdf_resolution_memory")
    assert [(r.times_applied, r.example.filename) for r in pdf.usage(cases).collect()] == [(2, "good.pdf")]
    assert cli.main(["run", str(tmp_path / "scans"), "-o", str(tmp_path / "refused")]) == 4
    seen = {name(r): r for r in files.read_files(spark, str(tmp_path / "scans")).collect()}
    assert seen["scan.pdf"].text == "\n\n".join(f"Texto reconhecido de uma página com palavras, folha {p}." for p in range(1, 12)) and seen["scan.pdf"].error is None


def test_missing_programs(spark, tmp_path):
    (tmp_path / "x.pdf").write_text("?")
    (row,) = read_pages(files.binary_files(spark, str(tmp_path))).collect()
    assert "not installed" in row.error and row.page_no is None
    assert "not installed" in files.read_files(spark, str(tmp_path)).first().error
    assert [r.rung for r in files.read_catalog(spark, str(tmp_path / "none")).collect()] == []


def test_stream(spark, tmp_path):
    from vellum.streaming.documents import canonicalise_stream

    schema = "doc_id long, text string, source_format string, source_edition string, translation_layer string"
    spark.createDataFrame([(1, "palavra " * 20, "txt", "one", None)], schema).write.parquet(str(tmp_path / "in"))
    query = canonicalise_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ckpt"), Config(min_size=5))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/batch=0/bodies")).count() == 1


def test_one_exchange_by_document(spark):
    """Offsets, depth and block types of a document need it together once."""
    df = segment.segment(docs(spark, "a\nb").withColumnRenamed("text", "body"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_same_results_whatever_the_partitions(spark, sf_dir):
    from vellum.registry import clean_body

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        runs = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            runs.append(sorted(tuple(r) for r in clean_body(spark, sf_dir).collect()))
        assert runs[0] == runs[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_run_summary_reads_each_text_once(spark, sf_dir):
    plan = registry.QUERIES["run_summary"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan  # texts are cut into lines before, for all parts together
