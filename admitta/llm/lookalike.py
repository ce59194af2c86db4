"""One consistent form for text that looks the same (problem 2).

Characters and strings that look alike are joined by union-find: compatibility forms and their plain
strings, composed letters and their decomposed strings, cedilla and comma-below letters, look-alike
letters of other alphabets, invisible characters and the empty string, blanks of any width. Strings
whose parts are alike are alike too, so the classes are closed under substitution. Each class is
represented by its member that is in consistent form and most frequent in the corpus. Text is
rewritten from left to right, longest pattern first, by an Aho-Corasick automaton.

Letters of another alphabet are rewritten only in words that are not really written in it: a word
without Latin letters that has a letter with no Latin look-alike keeps its alphabet.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.sources.tables import table

#: Letters of other alphabets and the Latin letters they look like.
CONFUSABLE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l", "Ӏ": "I",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ι": "i", "ρ": "p", "υ": "u",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "Ԍ": "G", "Ꙅ": "S", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z",
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "Տ": "S", "Օ": "O", "Լ": "L", "Ս": "U",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꭹ": "Y", "Ꮓ": "Z",
}
#: Cedilla letters that stand for the Romanian comma-below letters.
CEDILLA = {"ş": "ș", "Ş": "Ș", "ţ": "ț", "Ţ": "Ț"}
#: Hyphens that look like the ordinary one. Dashes and quotation marks are left alone.
HYPHENS = {"‐": "-", "‑": "-", "﹣": "-"}
#: Invisible characters outside the format category: joiners, fillers, variation selectors.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
#: Ranges whose composed letters are joined with their decomposed strings.
COMPOSED = ((0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000))

WORD = regex.compile(r"[\p{L}\p{M}]+")
LATIN = regex.compile(r"\p{Latin}")


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, s: str) -> str:
        self.parent.setdefault(s, s)
        while self.parent[s] != s:
            self.parent[s] = s = self.parent[self.parent[s]]
        return s

    def join(self, a: str, b: str) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b, key=lambda s: (len(s), s))] = min(a, b, key=lambda s: (len(s), s))
        return True

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for s in self.parent:
            out.setdefault(self.find(s), []).append(s)
        return out


def ordinary(s: str) -> bool:
    """In consistent form: composed, no compatibility form, nothing invisible, comma-below letters."""
    return all(not invisible(c) and c not in CEDILLA and c not in HYPHENS for c in s) and unicodedata.normalize("NFKC", s) == s


def invisible(c: str) -> bool:
    return c in INVISIBLE or unicodedata.category(c) == "Cf" or (unicodedata.category(c) == "Cc" and c not in "\t\n\r")


def alike(corpus: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Pairs that look alike inside one alphabet, for code points of the corpus and all composed letters."""
    for c in corpus:
        if invisible(c):
            yield c, ""
        elif unicodedata.category(c) == "Zs":
            yield c, " "
        else:
            kind, _, plain = unicodedata.decomposition(c).partition(">")
            flat = unicodedata.normalize("NFKC", c)
            if kind in ("<wide", "<narrow", "<font") or (kind == "<compat" and flat.isalpha()):
                if plain and flat != c:
                    yield c, flat
    for low, high in COMPOSED:
        for c in map(chr, range(low, high)):
            apart = unicodedata.normalize("NFD", c)
            if apart != c:
                yield c, apart
    yield from CEDILLA.items()
    yield from HYPHENS.items()


def close(classes: Classes) -> None:
    """Join strings whose parts are alike, until nothing changes: every round joins classes, so it ends."""
    changed = True
    while changed:
        by_parts: dict[tuple[str, ...], str] = {}
        changed = False
        for s in [s for s in classes.parent if len(s) > 1]:
            parts = tuple(classes.find(c) if c in classes.parent else c for c in s)
            changed |= classes.join(s, by_parts.setdefault(parts, s))


def representatives(classes: Classes, counts: dict[str, int], latin: bool) -> dict[str, str]:
    """Every string of a class to its representative: in consistent form and most frequent.

    A string is as frequent as its rarest code point. With ``latin``, a class that has Latin or
    alphabet-free members in consistent form is represented by one of them.
    """
    out: dict[str, str] = {}
    for members in classes.members().values():
        able = [s for s in members if ordinary(s)]
        if latin:
            able = [s for s in able if all(not c.isalpha() or LATIN.match(c) for c in s) and not set(s) & CONFUSABLE.keys()] or able
        if not able:
            continue
        best = min(able, key=lambda s: (-min((counts.get(c, 0) for c in s), default=sys.maxsize), len(s), s))
        out.update((s, best) for s in members if s != best and s)
    return out


def rules(counts: dict[str, int]) -> tuple[dict[str, str], dict[str, str]]:
    """Rewrites inside one alphabet, and rewrites across alphabets."""
    inside, across = Classes(), Classes()
    for a, b in alike(counts):
        inside.join(a, b)
        across.join(a, b)
    close(inside)
    for a, b in CONFUSABLE.items():
        across.join(a, b)
    close(across)
    there = set(counts)
    plain = {s: r for s, r in representatives(inside, counts, False).items() if set(s) <= there}
    # what the first rewriting can give must be known to the second one, too
    there |= {c for r in plain.values() for c in r}
    full = {s: r for s, r in representatives(across, counts, True).items() if set(s) <= there}
    return plain, full


@lru_cache(maxsize=8)
def automaton(pairs: tuple[tuple[str, str], ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for pattern, to in pairs:
        machine.add_word(pattern, (len(pattern), to))
    if pairs:
        machine.make_automaton()
    return machine


def rewrite(text: str, pairs: tuple[tuple[str, str], ...]) -> str:
    """Leftmost-longest replacement of all patterns."""
    if not pairs or not text:
        return text
    out, done = [], 0
    for end, (length, to) in automaton(pairs).iter_long(text):
        out += (text[done : end + 1 - length], to)
        done = end + 1
    return "".join((*out, text[done:])) if done else text


def really_foreign(word: str, across: dict[str, str]) -> bool:
    """Without Latin letters, and with a letter that no Latin letter looks like."""
    letters = [c for c in unicodedata.normalize("NFD", word) if c.isalpha()]
    if any(LATIN.match(c) and c not in CONFUSABLE for c in letters):
        return False
    return any(c not in across for c in letters)


def consistent(text: str, plain: tuple[tuple[str, str], ...], full: tuple[tuple[str, str], ...], across: dict[str, str]) -> str:
    """The consistent form; applied until nothing changes, as a rewriting can bring parts together.

    Rewritings that came back to an earlier text would never end and raise an error.
    """
    seen = {text}
    while True:
        flat = rewrite(text, plain)
        flat = WORD.sub(lambda m: m.group() if m.group().isascii() or really_foreign(m.group(), across) else rewrite(m.group(), full), flat)
        if flat == text:
            return text
        if flat in seen:
            raise ValueError(f"rewritings without end: {text!r}")
        seen.add(flat)
        text = flat


def code_points(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """How often each code point occurs in all texts; at most one entry per Unicode code point."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for column in batch.columns:
                for text in column:
                    seen.update(text.as_py() or "")
        if seen:
            yield pa.RecordBatch.from_pydict({"c": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    texts = df.select(*(F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(columns)))
    return {r[0]: r[1] for r in texts.mapInArrow(count, "c string, n long").groupBy("c").agg(F.sum("n")).collect()}


def consistent_column(text: Column, counts: dict[str, int]) -> Column:
    """The consistent form of a text column. ASCII text is in it already and never leaves the JVM."""
    inside, across = rules(counts)
    plain, full = tuple(inside.items()), tuple(across.items())

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return pd.Series([consistent(t, plain, full, across) if t else t for t in texts], dtype="object")

    odd = text.rlike(r"[^\t\n\r\x20-\x7e]")
    return F.when(odd, form(F.when(odd, text))).otherwise(text)


def consistent_values(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field_name, value, consistent, was_consistent): one row per distinct key, field and value.

    Null values give no row; an empty text is consistent. Rows without key are kept with a null key.
    """
    counts = code_points(df, columns)
    fields = F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(f"`{c}`").alias("value")) for c in columns))
    values = df.select(F.col(f"`{key}`").alias(key), F.explode(fields).alias("_f")).select(key, "_f.field_name", "_f.value").where(F.col("value").isNotNull())
    formed = values.dropDuplicates().withColumn("consistent", consistent_column(F.col("value"), counts))
    return formed.withColumn("was_consistent", F.col("value") == F.col("consistent"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return consistent_values(table(spark, folder, "programs"), "uid", ["name", "spots_raw"]).where("NOT was_consistent").select("uid", "field_name").dropDuplicates()


def p2_consistent(spark: SparkSession, folder: str) -> DataFrame:
    return consistent_values(table(spark, folder, "programs"), "uid", ["name", "spots_raw"])


QUERIES = {"p2_found": p2_found, "p2_consistent": p2_consistent}
SQL: dict[str, str] = {}
