"""Folding text to plain lower-case Latin letters, inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _table(extra: Mapping[str, str]) -> tuple[str, str]:
    """Letters with marks to their base letter, full-width forms to ASCII, blanks to the ordinary one."""
    to: dict[str, str] = {}
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii() and base.isalpha():
            to[c] = base
    to |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
    to |= {c: " " for c in map(chr, range(0x80, 0x3001)) if unicodedata.category(c) == "Zs"}
    to |= {"‐": "-", "‑": "-"} | dict(extra)
    return "".join(to), "".join(to.values())


def fold(text: Column, extra: Mapping[str, str] | None = None) -> Column:
    """Lower case without diacritics, marks, invisible characters and odd forms; ``extra`` adds letters to replace."""
    src, dst = _table(extra or {})
    plain = F.regexp_replace(F.translate(text, src, dst), r"[\p{M}\p{Cf}]", "")
    plain = F.replace(F.replace(plain, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))
    return F.lower(plain)
