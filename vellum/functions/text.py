"""Scalar text functions as Spark columns: white space, sizes, hashes, keys, and the key form of labels.

White space, letters and words follow Unicode, not Java's ASCII defaults, so patterns spell their classes out.
"""

from __future__ import annotations

import hashlib
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.config import ALL_TOKENS, BLOCK_TOKENS

#: One white-space character, as a Java class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: One character of a word.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


#: The same characters one by one: trimming by a set looks at the ends only, a pattern at every character.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def rtrim(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def ltrim(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def trim(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def bind(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def words(c: Column) -> Column:
    return F.filter(F.split(c, f"{WS}+", -1), lambda w: w != "")


def count_words(c: Column) -> Column:
    return F.size(words(c))


def strip_sentinels(c: Column) -> Column:
    """The text without marker tokens; what stands between a pair of them stays."""
    return F.regexp_replace(c, "|".join(ALL_TOKENS), "")


def body_size(c: Column, unit: str = "words") -> Column:
    """Words, or characters without outer white space, of the prose."""
    if unit == "words":
        return count_words(strip_sentinels(c))
    if unit == "chars":
        return F.length(trim(strip_sentinels(c)))
    raise ValueError(f"unknown unit {unit!r}: words or chars")


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("string").cast("binary"), 256)


def freeze_key(raw_hash: Column, filling_hash: Column, engine: str) -> Column:
    """One key for input, configuration and engine; a missing configuration is the empty-set sign."""
    return sha256(F.concat_ws("\x1f", raw_hash, F.coalesce(filling_hash, F.lit("∅")), F.lit(engine)))


def repertoire_hash(patterns: tuple[str, ...]) -> str:
    return hashlib.sha256("\x1f".join(patterns).encode()).hexdigest()


def is_sentinel(c: Column) -> Column:
    return trim(c).isin(*BLOCK_TOKENS)


def is_blank(c: Column) -> Column:
    return ltrim(c) == ""


def half_even(c: Column, digits: int) -> Column:
    """Rounded, ties to even. Compare unrounded values where a tie's last digit matters."""
    return F.bround(c, digits)


@cache
def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From Unicode's own tables: characters that fold to one, those that vanish, and those that fold to several."""
    one, to, gone, many = [], [], [], []
    for code in (*range(0x80, 0x250), *range(0x300, 0x370), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFB00, 0xFB07), *range(0xFF10, 0xFF5B)):
        ch = chr(code)
        if unicodedata.category(ch) in ("Cn", "Cs"):
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).casefold()
        if folded == ch:
            continue
        if len(folded) == 1:
            one.append(ch)
            to.append(folded)
        elif not folded:
            gone.append(ch)
        else:
            many.append((ch, folded))
    return "".join(one) + "".join(gone), "".join(to), tuple(many)


def label_key(c: Column) -> Column:
    """Without accents, case-folded, white space collapsed: exact for Latin scripts, full-width ones too, and general punctuation.
    Labels are Latin, so other scripts, which keep their accents here, match none either way."""
    matching, replacing, many = _folds()
    out = F.lower(F.translate(c, matching, replacing))
    several = "".join(ch for ch, _ in many)
    spelt = out
    for ch, folded in many:
        spelt = F.replace(spelt, F.lit(ch), F.lit(folded))
    out = F.when(out.rlike(f"[{several}]"), spelt).otherwise(out)
    return trim(F.regexp_replace(out, f"{WS}+", " "))


