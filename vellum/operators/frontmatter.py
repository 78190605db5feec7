"""Front-matter regimes: signals of single blocks, then the first qualified run of navigation blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.config import FRONT_ZONE, MIN_RUN
from vellum.functions.text import NOT_WORD, WS, count_words, label_key

NAVIGATION, EDITORIAL, BODY_START = "navigation_noise", "editorial_discourse", "main_body_start"

# --- fixed values -------------------------------------------------------------------------------------------
STRUCTURAL_LABELS = (
    "sumario", "indice", "indice geral", "indice de materias", "indice remissivo",
    "indice onomastico", "conteudo", "conteudos",
    "capa", "rosto", "folha de rosto", "pagina de rosto", "falsa folha de rosto",
    "landmarks", "guia", "marcadores",
    "lista de figuras", "lista de tabelas", "lista de ilustracoes",
    "lista de abreviaturas", "lista de mapas",
    "cover", "title page", "table of contents", "contents", "toc",
    "copyright", "copyright page", "creditos", "creditos editoriais",
    "ficha catalografica", "ficha tecnica",
)
EDITORIAL_PREFIXES = (
    "prefacio", "introducao", "apresentacao", "nota do tradutor",
    "nota da tradutora", "nota dos tradutores", "nota da edicao",
    "nota do editor", "nota do autor", "nota previa", "nota a edicao",
    "prologo", "posfacio", "esclarecimentos", "advertencia",
    "abertura", "ao leitor",
)
CONNECTIVES = (
    "porque", "portanto", "contudo", "todavia", "entretanto", "no entanto",
    "porem", "embora", "ou seja", "isto e", "por exemplo", "alem disso",
    "dessa forma", "desse modo", "enquanto", "ainda que", "de modo que",
    "por isso", "uma vez que", "assim como", "tanto que", "de maneira que",
)
CHAPTER_WORDS = ("capitulo", "cap", "parte", "chapter", "part", "livro", "tomo", "secao", "titulo")
ORDINALS = ("primeir", "segund", "terceir", "quart", "quint", "sext", "setim", "oitav", "non", "decim")
HEADING_WORDS, LONG_WORDS, SEVERAL_WORDS, JOINED_WORDS = 20, 25, 12, 20

_EDGE = f"(?:$|{NOT_WORD})"
CONNECTIVE = f"(?:^|{NOT_WORD})(?:{'|'.join(CONNECTIVES)}){_EDGE}"
CHAPTER = f"^(?:{'|'.join(CHAPTER_WORDS)}){_EDGE}|^(?:{'|'.join(ORDINALS)})[oa] parte{_EDGE}"
LEADER = rf"(?:\.\.+|\.(?:{WS}\.){{2,}}|…){WS}*\p{{Nd}}{{1,4}}{WS}*$"
DOT_RUN = rf"\.(?:{WS}*\.)+"
ENDS = rf"[.!?…][\"'”’)\]»]*{WS}*$"


def with_signals(blocks: DataFrame, text: str = "text") -> DataFrame:
    """The thirteen signals of each block, beside its columns."""
    t = F.col(text)
    out = blocks.withColumns({
        "_key": label_key(t),
        "word_count": count_words(t),
        "sentences": F.regexp_count(F.regexp_replace(t, DOT_RUN, "."), F.lit("[.!?…]")),
        "ends_sentence": t.rlike(ENDS),
        "has_toc_leader": t.rlike(LEADER),
    })
    key, wc = F.col("_key"), F.col("word_count")
    out = out.withColumns({
        "has_connective": key.rlike(CONNECTIVE),
        "is_structural_label": key.isin(*STRUCTURAL_LABELS),
        "is_numbered_chapter": key.rlike(CHAPTER),
    })
    long = (wc >= LONG_WORDS) & (F.col("sentences") >= 1)
    several = (F.col("sentences") >= 2) & (wc >= SEVERAL_WORDS)
    joined = F.col("has_connective") & (wc >= JOINED_WORDS)
    out = out.withColumn("is_discursive", ~F.col("has_toc_leader") & (long | several | joined))
    quiet = ~F.col("is_discursive")
    prefix = key.rlike("^(?:" + "|".join(EDITORIAL_PREFIXES) + ")")
    out = out.withColumns({
        "is_heading_like": quiet & ~F.col("ends_sentence") & ~F.col("has_connective") & wc.between(1, HEADING_WORDS),
        "is_editorial_heading": quiet & (wc <= HEADING_WORDS) & prefix,
        "is_strong_nav_marker": F.col("is_structural_label") | F.col("is_numbered_chapter") | F.col("has_toc_leader"),
    })
    return out.withColumns({
        "is_nav_candidate": quiet & (F.col("is_strong_nav_marker") | F.col("is_heading_like") | F.col("is_editorial_heading")),
        "is_section_heading": F.col("is_editorial_heading") | F.col("is_numbered_chapter"),
    }).drop("_key")


SIGNALS = (
    "word_count", "sentences", "ends_sentence", "has_connective", "is_structural_label", "is_editorial_heading", "is_numbered_chapter",
    "has_toc_leader", "is_discursive", "is_heading_like", "is_nav_candidate", "is_strong_nav_marker", "is_section_heading",
)


def with_labels(blocks: DataFrame, min_run: int = MIN_RUN, front_zone: int = FRONT_ZONE) -> DataFrame:
    """blocks (doc_id, idx from 0, text, ...) -> those of the front zone, with label (null: untouched body).
    Only windows by doc_id: no exchange beyond the one that brought a document together."""
    doc = Window.partitionBy("doc_id")
    in_order = doc.orderBy("idx")
    out = with_signals(blocks.where(F.col("idx") < front_zone))
    island = F.col("idx") - F.row_number().over(Window.partitionBy("doc_id", "is_nav_candidate").orderBy("idx"))
    run = Window.partitionBy("doc_id", "is_nav_candidate", "_island")
    out = out.withColumn("_island", island).withColumns({
        "_start": F.min("idx").over(run), "_end": F.max("idx").over(run),
        "_strong": F.max("is_strong_nav_marker").over(run),
        "_next_discursive": F.coalesce(F.lead("is_discursive").over(in_order), F.lit(False)),
    })
    qualified = F.col("is_nav_candidate") & F.col("_strong") & (F.col("_end") - F.col("_start") + 1 >= min_run)
    chosen: Column = F.min(F.when(qualified, F.struct("_start", "_end"))).over(doc)
    out = out.withColumn("_run", chosen).withColumns({"_s": F.col("_run._start"), "_e": F.col("_run._end")})
    opens = F.col("_next_discursive") & (F.col("is_section_heading") | F.col("is_heading_like")) & ~F.col("has_toc_leader") & ~F.col("is_structural_label")
    label = (
        F.when((F.col("idx") == F.col("_e")) & opens, F.when(F.col("is_editorial_heading"), EDITORIAL).otherwise(BODY_START))
        .when(F.col("idx").between(F.col("_s"), F.col("_e")), NAVIGATION)
        .when(F.col("is_structural_label"), NAVIGATION)
        .when(F.col("idx") == F.col("_e") + 1, BODY_START)
    )
    return out.withColumn("label", label).drop("_island", "_start", "_end", "_strong", "_next_discursive", "_run", "_s", "_e")
