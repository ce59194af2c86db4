"""Text normalisation and tokens (N1 to N5, N9 to N16) as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admitta.functions.vocab import ABBREVIATIONS

#: Runs of blanks of any kind, and such runs at both ends.
BLANKS = r"[\s\p{Z}]+"
EDGES = r"^[\s\p{Z}]+|[\s\p{Z}]+$"

_DIACRITICS = ("ăâîșşțţ", "aaisstt")


def lower_ascii(c: Column) -> Column:
    """Lower case, Romanian letters to their base letters."""
    return F.translate(F.lower(c), *_DIACRITICS)


def _no_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " ")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def match_form(c: Column) -> Column:
    """Lower case, base letters, punctuation to blanks, single blanks; null gives an empty text."""
    return F.coalesce(collapse(_no_punctuation(lower_ascii(c))), F.lit(""))


def rule_form(c: Column) -> Column:
    """Like N1 but with blanks kept as they are inside."""
    return _no_punctuation(lower_ascii(F.regexp_replace(c, EDGES, "")))


def _compositions() -> tuple[tuple[str, str], ...]:
    marks = {m: [] for m in "̧̦̆̂́̀̈"}
    for c in map(chr, range(0xC0, 0x250)):
        apart = unicodedata.normalize("NFD", c)
        if len(apart) == 2 and apart[1] in marks:
            marks[apart[1]].append((apart, c))
    return tuple(p for pairs in marks.values() for p in pairs if p[0][0] in "aAiIsStTeEoOuU")


def composed(c: Column) -> Column:
    """N3 inside the JVM: combining forms of Romanian and French letters composed, cedillas to commas below, trimmed."""
    out = c
    for apart, whole in _compositions():
        out = F.replace(out, F.lit(apart), F.lit(whole))
    return F.regexp_replace(F.translate(out, "şŞţŢ", "șȘțȚ"), EDGES, "")


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def composed_nfc(c: Column) -> Column:
    """N3 in full: canonical composition of any letter, then cedillas to commas below, trimmed."""
    return F.regexp_replace(F.translate(_nfc(c), "şŞţŢ", "șȘțȚ"), EDGES, "")


def _latin_letters() -> tuple[str, str]:
    to = {}
    for c in map(chr, range(0xC0, 0x250)):
        base = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(base) == 1:
            to[c] = base
    return "".join(to), "".join(to.values())


LATIN = _latin_letters()


def slug(c: Column) -> Column:
    """Lower case, brackets and four-digit runs left out, base letters, all else to single hyphens."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), r"\(.*?\)", ""), r"\d{4}", "")
    ascii_only = F.regexp_replace(F.translate(bare, *LATIN), r"[^\x00-\x7f]", "")
    return F.trim(F.regexp_replace(ascii_only, r"[^a-z0-9]+", "-"), F.lit("-"))


def expand_abbreviations(c: Column, table: Mapping[str, str] = ABBREVIATIONS) -> Column:
    """Whole words replaced, in the order of the table."""
    for short, long in table.items():
        c = F.regexp_replace(c, rf"(?i)\b{short}\b", long)
    return c


def truth_form(c: Column) -> Column:
    """Lower case, composed comma-below letters to base letters, hyphens to blanks, trimmed."""
    return F.trim(F.replace(F.translate(F.lower(c), "ăâșțî", "aasti"), F.lit("-"), F.lit(" ")))


def title_case(c: Column) -> Column:
    """Each run of letters with its marks begins with a capital and goes on in small letters."""
    apart = F.regexp_replace(c, r"(?<=[^\p{L}\p{M} ])(?=\p{L})", "\x01 ")
    return F.replace(F.initcap(apart), F.lit("\x01 "), F.lit(""))


def display_name(c: Column) -> Column:
    """Link words and square brackets left out, single blanks, words of an all-capitals name capitalised."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?i)\(?(?:aici|detalii|vezi|link)\)?", ""), r"\[.*?\]", "")
    flat = collapse(bare)
    cased = F.when((F.upper(flat) == flat) & flat.rlike(r"\p{L}"), title_case(flat)).otherwise(flat)
    return F.when(c.isNull() | (c == ""), "Unknown").otherwise(F.replace(cased, F.lit(" ,"), F.lit(",")))


def is_title(c: Column) -> Column:
    """Every word begins with a capital and goes on in small letters."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"(^|[^\p{Lu}\p{Ll}])\p{Ll}") & ~c.rlike(r"[\p{Lu}\p{Ll}]\p{Lu}")


def unbroken(c: Column) -> Column:
    """Words broken at line ends joined, lines joined."""
    return F.replace(F.replace(composed(c), F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))


def markup_text(c: Column) -> Column:
    """Text of an HTML fragment: tags to blanks, common entities decoded, single blanks."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse(out)


def snippet(c: Column, size: int = 100) -> Column:
    """N14."""
    return F.substring(c, 1, size)


def short_id(c: Column, size: int = 8) -> Column:
    """N15."""
    return F.left(c, F.lit(size))


def tokens(c: Column) -> Column:
    """Parts between blanks, without empty ones."""
    return F.filter(F.split(c, BLANKS), lambda t: t != "")


def repair_encoding(c: Column) -> Column:
    """SC17: text read as Latin-1 though it was UTF-8, told by the letter it shows for the first byte; else unchanged."""
    wrong = F.contains(c, F.lit("Ä")) & ~F.contains(c, F.lit("ă")) & c.rlike(r"^[\x00-\xff]*$")
    again = F.encode(F.when(wrong, c), "ISO-8859-1").cast("string")
    return F.when(wrong & F.is_valid_utf8(again), again).otherwise(c)
