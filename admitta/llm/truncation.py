"""Text cut off by field limits (problem 8).

Three kinds of evidence decide about a text that does not end like a finished one:

* the vocabulary trie of the corpus, kept as a table with one row per node: the final token is no
  known word, or hardly ever one, but a proper prefix of known words;
* the same for words in context: the last words of the text are, in the corpus, practically always
  followed by another word and not by the end of a sentence or line;
* length: the text is as long, in characters or bytes, as the limit its source cuts at.

A mark of omission, half a character or tag, an open bracket or half a table row at the end needs no
further evidence. Lines that end many different documents, such as signatures, are whole.

A text that is there in several copies says no more about its end than one: shares and closing lines
are counted over distinct texts. Only how often a word or context was seen counts all documents.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.session import materialize
from admitta.sources.tables import table

#: Bits of the filter that keeps contexts no text ends with out of the counts.
FILTER_BITS = 1 << 22
#: Observations a context needs, and the share of ends up to which it counts as never ending.
LEAST_SEEN, MOST_ENDED = 20, 0.02
#: A half word stands alone at most so often, or at this share of the words it begins.
HALF_ALONE, HALF_SHARE = 1, 0.002
#: A closing line ends at least so many different texts, and this share of all distinct ones.
CLOSING_LEAST, CLOSING_SHARE = 5, 0.0005
#: A limit: at least so many texts and this share of the source at one length, and longer ones at most this share of those.
LIMIT_LEAST, LIMIT_SHARE, LIMIT_LONGER = 4, 0.02, 0.25
#: Tokens counted in one go, and tokens told apart before the numbering starts anew (three numbers fit into one of 64 bits).
CHUNK_TOKENS, MOST_KNOWN = 1 << 20, 1 << 20

TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
ENTITY = re.compile(r"&(?:[a-zA-Z]{2,8}|#\d+|#x[0-9a-fA-F]+);")
TAGS = re.compile(r"<[a-zA-Z/][^<>]*>|&[a-zA-Z]{2,8};|&#\d+;|&#x[0-9a-fA-F]+;")
#: The beginnings of a tag, of an entity and of an escape.
HALF_TAG = re.compile(r"<(?:/|/?[a-zA-Z][^<>\n]*)?")
HALF_ENTITY = re.compile(r"&(?:#(?:x?[0-9a-fA-F]*)?|[a-z]{0,7})")
HALF_ESCAPE = re.compile(r"\\(?:u[0-9a-fA-F]{0,3})?")
#: Marks that say that a text goes on: in brackets, and after three dots.
BRACKETED = re.compile(r"[\[(]\s*(?:…|\.{3}|continuare|va urma|continued|à suivre|suite)\s*[\])]", re.IGNORECASE)
GOES_ON = ("citeste mai mult", "citește mai mult", "mai mult", "read more", "lire la suite")
CLOSERS = "»”\"')]"
TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*|\d+(?:[.,:]\d+)*|\n|\S")
ENDS = set(".!?…\n|»”\")]")
OPEN = set(",;:([{«„/&+|–—-")
RAW = re.compile(r"[@#/]")
#: What holds fragments instead of words: broken characters, escapes, number entities and addresses.
STRAY = re.compile(r"�|\\u[0-9a-fA-F]|&#|://|\w@\w|[a-z0-9-]\.[a-z]{2}")
DOTTED = re.compile(r"\.[a-z]{2}")
PAIRS = (("(", ")"), ("[", "]"), ("«", "»"), ("„", "”"))

TAIL = "doc_id long, source string, chars int, bytes int, digest string, state string, token string, raw boolean, line string, above string, bare_row boolean, c1 string, c2 string, c3 string"


def context(words: list[str]) -> tuple[str, str, str]:
    """The last word, the last two and the last three, from the beginning of the sentence on."""
    w = ["^", "^", *words][-3:]
    return w[2], f"{w[1]} {w[2]}", f"{w[0]} {w[1]} {w[2]}"


def tokens_of(text: str) -> list[str]:
    """Words, numbers, line ends and single signs, in lower case."""
    return TOKEN.findall(text.lower())


def line_digest(line: str) -> str:
    """The same for texts that differ in case, blanks or numbers only."""
    return hashlib.md5(re.sub(r"\d+", "0", " ".join(line.lower().split())).encode("utf-8", "replace")).hexdigest()


def end_of(text: str) -> int:
    """Where the text ends, tags, entities and blanks at its end left out, however many there are."""
    end = len(text)
    while end:
        last = text[end - 1]
        if last.isspace():
            end -= 1
            continue
        at = text.rfind("<", 0, end) if last == ">" else text.rfind("&", 0, end) if last == ";" else -1
        if at < 0 or not (TAG if last == ">" else ENTITY).fullmatch(text, at, end):
            break
        end = at
    return end


def broken(text: str, end: int) -> bool:
    """The text stops inside a character, tag, entity or escape."""
    if text[end - 1] == "�":
        return True
    for sign, half in (("<", HALF_TAG), ("&", HALF_ENTITY), ("\\", HALF_ESCAPE)):
        at = text.rfind(sign, 0, end)
        if at >= 0 and half.fullmatch(text, at, end):
            return True
    return False


def _back(text: str, end: int, signs: str) -> int:
    while end and text[end - 1] in signs:
        end -= 1
    return end


def _blanks_back(text: str, end: int) -> int:
    while end and text[end - 1].isspace():
        end -= 1
    return end


def dots_before(text: str, end: int) -> int:
    """Where the ellipsis begins that the text ends with at ``end``; -1 without one."""
    if end and text[end - 1] == "…":
        return end - 1
    start = _back(text, end, ".")
    return start if end - start >= 3 else -1


def marked_cut(text: str, end: int) -> bool:
    """A mark of omission in brackets, or dots with an invitation to read on, at the end."""
    at = end
    while at and (text[at - 1] in ".>»" or text[at - 1].isspace()):
        at -= 1
    if at and text[at - 1] in "])":
        start = max(text.rfind("[", 0, at), text.rfind("(", 0, at))
        return start >= 0 and bool(BRACKETED.fullmatch(text, start, at))
    for words in GOES_ON:
        if text[max(0, at - len(words)) : at].lower() == words and dots_before(text, _blanks_back(text, at - len(words))) >= 0:
            return True
    return False


def last_line_start(text: str, end: int) -> int:
    """Where the last line begins; a line end inside a tag is none."""
    start = text.rfind("\n", 0, end) + 1
    while start:
        at = text.rfind("<", 0, start)
        tag = TAGS.match(text, at, end) if at >= 0 and text.rfind(">", at, start) < 0 else None
        if not tag or tag.end() <= start:
            break
        start = text.rfind("\n", 0, at) + 1
    return start


def tail(text: str) -> dict:
    """What the end of a text shows. ``state``: cut, marked (by an ellipsis), loose (no full stop) or whole."""
    out = {"state": "whole", "token": None, "raw": False, "line": None, "above": None, "bare_row": False, "c1": None, "c2": None, "c3": None}
    end = end_of(text)
    if not end:
        return out
    if broken(text, end) or marked_cut(text, end):
        return out | {"state": "cut"}
    stop = _blanks_back(text, _back(text, end, CLOSERS))
    dots = dots_before(text, stop)
    if dots < 0 and stop and text[stop - 1] in ".!?":
        return out
    stop = _blanks_back(text, dots) if dots >= 0 else end
    line_at = text.rfind("\n", 0, end) + 1
    last = text[line_at:end]
    if stop and text[stop - 1] in OPEN or any(last.count(a) > last.count(b) for a, b in PAIRS):
        return out | {"state": "cut"}
    above = text[text.rfind("\n", 0, line_at - 1) + 1 : line_at - 1] if line_at else ""
    if above.count("|") >= 2 and 0 < last.count("|") < above.count("|"):
        return out | {"state": "cut"}
    out |= {"state": "marked" if dots >= 0 else "loose", "line": line_digest(last), "above": line_digest(text[:line_at])}
    out["bare_row"] = above.count("|") >= 2 and bool(re.fullmatch(r"[^\W\d_]+(?:[ -][^\W\d_]+)*", last.strip()))
    body = text[last_line_start(text, stop) : stop]
    words: list[str] = []
    for t in tokens_of(TAGS.sub(" ", body) if "<" in body or "&" in body else body):
        if t in ENDS:
            words = []
        elif t[0].isalnum():
            words.append("0" if t[0].isdigit() else t)
    parts = body.split()
    final = parts[-1] if parts else ""
    if RAW.search(final):
        out |= {"token": final.lower(), "raw": True}
    elif words and final and final[-1].isalpha():
        out["token"] = words[-1]
    if words and not out["raw"]:
        out["c1"], out["c2"], out["c3"] = context(words)
    return out


def _tails(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``tail`` of texts behind the columns that are passed on."""
    names = [f.split()[0] for f in TAIL.split(", ")]
    types = {"raw": pa.bool_(), "bare_row": pa.bool_()}
    for batch in batches:
        rows = [tail(text) for text in batch.column("text").to_pylist()]
        made = {n: pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names[5:]}
        yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names[:5]} | made)


def slot(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) & (FILTER_BITS - 1)


def stray_words(plain: str) -> Counter:
    """The words that stand beside broken characters or in addresses, the last word of the text left out."""
    out: list[str] = []
    if ("�" in plain or "\\u" in plain or "&#" in plain or "://" in plain or "@" in plain or DOTTED.search(plain)) and STRAY.search(plain):
        for m in re.finditer(r"\S+", plain):
            if STRAY.search(m[0]):
                tokens = tokens_of(m[0])
                if not plain[m.end() :].strip(" \t\r"):
                    tokens = tokens[:-1]
                out += [t for t in tokens if t[0].isalpha()]
    return Counter(out)


class TokenCounter:
    """Counts words and wanted contexts of many texts at a time, with numbers in place of tokens.

    Number 0 is the beginning of a sentence, 1 stands for all numbers. A text's last token is never
    counted, as it may be half a word.
    """

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.number["^"], self.number["0"]
        self.names = ["^", "0"]
        #: 0 for signs that say nothing, 1 for ends, 2 for words and numbers.
        self.kind = np.array([1, 2], dtype=np.int8)
        self.folded = np.array([0, 1], dtype=np.int64)
        self.asked = np.array([False, self.wanted[slot("0")]])

    def learn(self) -> None:
        new = list(self.number)[len(self.names) :]
        self.names += new
        at = len(self.kind)
        self.kind = np.append(self.kind, np.array([1 if t in ENDS else 2 if t[0].isalnum() else 0 for t in new], dtype=np.int8))
        digit = np.array([t[0].isdigit() for t in new], dtype=bool)
        self.folded = np.append(self.folded, np.where(digit, 1, np.arange(at, at + len(new))))
        self.asked = np.append(self.asked, np.array([bool(self.wanted[slot(t)]) for t in new], dtype=bool))

    def count(self, texts: list[tuple[list[str], int]]) -> Iterator[tuple[str, list[str], np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, keys, goes_on, ends, n) for texts given as (tokens, copies)."""
        t = np.fromiter(map(self.number.__getitem__, chain.from_iterable(tokens for tokens, _ in texts)), dtype=np.int64)
        sizes = np.array([len(tokens) for tokens, _ in texts])
        copies = np.repeat(np.array([c for _, c in texts], dtype=np.int64), sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        self.learn()
        kind = self.kind[t]
        counts = np.ones(len(t), dtype=bool)
        counts[np.cumsum(sizes)[sizes > 0] - 1] = False
        ends = np.append(kind[1:] == 1, False)
        seen = np.flatnonzero(kind > 0)
        t, kind, counts, ends, copies, doc = self.folded[t[seen]], kind[seen], counts[seen], ends[seen], copies[seen], doc[seen]
        word = kind == 2
        after = np.zeros(len(t), dtype=bool)
        after[1:] = word[:-1] & (doc[1:] == doc[:-1])
        b = np.zeros_like(t)
        b[1:] = np.where(after[1:], t[:-1], 0)
        a = np.zeros_like(t)
        a[1:] = np.where(after[1:], b[:-1], 0)
        keep = word & counts
        t, a, b, ends, copies = t[keep], a[keep], b[keep], ends[keep], copies[keep]
        yield from self._rows("word", t, ends, copies, lambda ids: [self.names[i] for i in ids], lambda ids: ids != 1)
        for size in (1, 2, 3):
            # a wanted context of three words ends with wanted ones of two and of one
            key = t if size == 1 else b << 20 | t if size == 2 else a << 40 | b << 20 | t
            names = lambda ids, n=size: [" ".join(self.names[(i >> 20 * k) & (MOST_KNOWN - 1)] for k in reversed(range(n))) for i in ids]
            ids, where = np.unique(key, return_inverse=True)
            hit = self.asked[ids] if size == 1 else np.array([bool(self.wanted[slot(s)]) for s in names(ids.tolist())], dtype=bool)
            some = hit[where] if len(ids) else np.zeros(0, dtype=bool)
            t, a, b, ends, copies, key = t[some], a[some], b[some], ends[some], copies[some], key[some]
            yield from self._rows("context", key, ends, copies, names)
        if len(self.names) > MOST_KNOWN // 2:
            self.reset()

    @staticmethod
    def _rows(kind, key, ends, copies, names, able=None):
        ids, where = np.unique(key, return_inverse=True)
        if not len(ids):
            return
        went = np.bincount(where, weights=~ends, minlength=len(ids)).astype(np.int64)
        ended = np.bincount(where, weights=ends, minlength=len(ids)).astype(np.int64)
        n = np.bincount(where, weights=copies, minlength=len(ids)).astype(np.int64)
        if able is not None:
            ok = able(ids)
            ids, went, ended, n = ids[ok], went[ok], ended[ok], n[ok]
        yield kind, names(ids.tolist()), went, ended, n


def counter(wanted: np.ndarray):
    """Counts words, stray words, raw tokens and wanted contexts of distinct texts: (kind, key, goes_on, ends, n), n over all their copies. The last word of a text does not count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, size = TokenCounter(wanted), [], 0
        raw: dict[str, list[int]] = {}
        stray: Counter[str] = Counter()

        def rows(kind, keys, went, ended, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(keys), pa.string()), "key": pa.array(keys, pa.string()), "goes_on": pa.array(went, pa.int64()), "ends": pa.array(ended, pa.int64()), "n": pa.array(n, pa.int64())})

        def flush() -> Iterator[pa.RecordBatch]:
            yield from (rows(*found) for found in tokens.count(held))
            yield rows("raw", list(raw), [n for n, _ in raw.values()], [0] * len(raw), [c for _, c in raw.values()])
            yield rows("stray", list(stray), list(stray.values()), [0] * len(stray), [0] * len(stray))
            held.clear()
            raw.clear()
            stray.clear()

        for batch in batches:
            for text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                plain = TAGS.sub(" ", text) if "<" in text or "&" in text else text
                if "@" in plain or "#" in plain or "/" in plain:
                    for t in plain.split():
                        if "@" in t or "#" in t or "/" in t:
                            n = raw.setdefault(t.lower(), [0, 0])
                            n[0] += 1
                            n[1] += copies
                stray.update(stray_words(plain))
                found = tokens_of(plain)
                held.append((found, copies))
                size += len(found)
                if size >= CHUNK_TOKENS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def _slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {slot(s) for c in batch.columns for s in c.to_pylist() if s}
        yield pa.RecordBatch.from_pydict({"slot": pa.array(sorted(found), pa.int32())})


def length_limits(tails: DataFrame) -> DataFrame:
    """(source, unit, at): lengths at which the texts of a source pile up, with hardly any longer ones. Copies count once."""
    tails = tails.select("source", "digest", "chars", "bytes").dropDuplicates(["source", "digest"])
    sizes = tails.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("at")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("at")))).alias("x")).select("source", "x.*")
    piles = sizes.groupBy("source", "unit", "at").agg(F.count(F.lit(1)).alias("n"))
    totals = tails.groupBy("source").agg(F.count(F.lit(1)).alias("all"))
    tall = piles.join(totals, "source").where((F.col("n") >= LIMIT_LEAST) & (F.col("n") >= LIMIT_SHARE * F.col("all")))
    longer = tall.alias("t").join(piles.alias("p"), (F.col("t.source") == F.col("p.source")) & (F.col("t.unit") == F.col("p.unit")) & (F.col("p.at") > F.col("t.at")), "left")
    over = longer.groupBy("t.source", "t.unit", "t.at", "t.n").agg(F.coalesce(F.sum("p.n"), F.lit(0)).alias("over"))
    return over.where(F.col("over") <= LIMIT_LONGER * F.col("n")).select("source", "unit", "at")


def trie(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per node of the depths asked for: (kind, node, as_word, below) with the occurrences ending at it in distinct texts, stray ones left out, and below it in all."""
    words = counts.where("kind IN ('word', 'stray', 'raw')")
    once = F.col("goes_on") + F.col("ends")
    depth = F.explode(F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda n: n <= F.length("key")))
    nodes = words.select(F.when(F.col("kind") == "raw", "raw").otherwise("word").alias("kind"), F.when(F.col("kind") == "stray", -once).otherwise(once).alias("once"), "key", "n", depth.alias("size"))
    return nodes.groupBy("kind", F.substring("key", F.lit(1), F.col("size")).alias("node")).agg(
        F.sum(F.when(F.col("size") == F.length("key"), F.col("once")).otherwise(0)).alias("as_word"), F.sum(F.when(F.col("size") < F.length("key"), F.col("n")).otherwise(0)).alias("below")
    )


def measured(text: Column) -> list[Column]:
    return [F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), F.md5(text).alias("digest")]


def examine(documents: DataFrame) -> DataFrame:
    """(doc_id, source, truncated, evidence), one row per document.

    Null, empty and blank texts are whole; so are texts that end with a full stop. Copies of a text
    that was cut at the limit of its source are cut wherever they are.
    """
    texts = documents.select("doc_id", "source", "text").where(F.col("text").isNotNull() & (F.length("text") > 0))
    tails = materialize(texts.select("doc_id", "source", *measured(F.col("text")), "text").mapInArrow(_tails, TAIL))
    asked = tails.where("state IN ('loose', 'marked')")
    slots = asked.select("c1", "c2", "c3").mapInArrow(_slots, "slot int").dropDuplicates().toPandas()["slot"].to_numpy()  # at most FILTER_BITS
    wanted = np.zeros(FILTER_BITS, dtype=bool)
    wanted[slots] = True
    distinct = texts.groupBy(F.md5("text").alias("digest")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).select("text", "copies")
    counted = distinct.mapInArrow(counter(wanted), "kind string, key string, goes_on long, ends long, n long")
    counts = materialize(counted.groupBy("kind", "key").agg(F.sum("goes_on").alias("goes_on"), F.sum("ends").alias("ends"), F.sum("n").alias("n")))

    # the trie, looked up once per distinct token
    tokens = asked.where(F.col("token").isNotNull()).select(F.when(F.col("raw"), "raw").otherwise("word").alias("kind"), F.col("token").alias("node")).dropDuplicates()
    sizes = sorted(r[0] for r in tokens.select(F.length("node")).distinct().collect())  # lengths of tokens
    nodes = trie(counts, sizes).join(tokens, ["kind", "node"], "left_semi")
    cut_words = nodes.where(((F.col("kind") == "word") & (F.col("as_word") <= F.greatest(F.lit(HALF_ALONE), HALF_SHARE * F.col("below"))) & (F.col("below") >= 2)) | ((F.col("kind") == "raw") & (F.col("below") > F.col("as_word"))))
    cut_words = cut_words.select((F.col("kind") == "raw").alias("raw"), F.col("node").alias("token"), F.lit(True).alias("half_word"))

    seen = counts.where("kind = 'context'").select("key", "n", (F.col("ends") / (F.col("goes_on") + F.col("ends"))).alias("share"))
    judged = asked
    for c in ("c1", "c2", "c3"):
        judged = judged.join(seen.select(F.col("key").alias(c), F.col("n").alias(f"{c}_n"), F.col("share").alias(f"{c}_share")), c, "left")
    share = F.lit(None).cast("double")
    for c in ("c1", "c2", "c3"):
        share = F.when(F.col(f"{c}_n") >= LEAST_SEEN, F.col(f"{c}_share")).otherwise(share)
    judged = judged.withColumn("end_share", share).join(cut_words, ["raw", "token"], "left")

    all_texts = tails.select("digest").distinct().count()
    lines = asked.select("line", "above").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("closes"))
    closing = lines.where(F.col("closes") >= max(CLOSING_LEAST, CLOSING_SHARE * all_texts)).select("line", F.lit(True).alias("closing"))
    judged = judged.join(closing, "line", "left")

    limits = length_limits(tails)
    at_limit = tails.join(limits, "source").where(  # per source at most 1 / LIMIT_SHARE lengths in two units
        ((F.col("unit") == "chars") & (F.col("chars") == F.col("at"))) | ((F.col("unit") == "bytes") & F.col("bytes").between(F.col("at") - 3, F.col("at")))
    )
    limited = at_limit.where("state <> 'whole'").select("digest").dropDuplicates().withColumn("limited", F.lit(True))
    judged = judged.join(limited, "digest", "left")

    evidence = (
        F.when(F.col("limited"), "length")
        .when(F.col("closing"), None)
        .when(F.col("half_word"), "half word")
        .when(F.col("bare_row"), "half row")
        .when(F.col("end_share") <= MOST_ENDED, "context")
        .when((F.col("state") == "marked") & (F.coalesce(F.col("end_share"), F.lit(0.0)) < 0.5), "mark")
    )
    found = judged.select("doc_id", "source", evidence.alias("evidence"))
    rest = tails.where("state NOT IN ('loose', 'marked')").select("doc_id", "source", F.when(F.col("state") == "cut", "break").alias("evidence"))
    empty = documents.where(F.col("text").isNull() | (F.length("text") == 0)).select("doc_id", "source", F.lit(None).cast("string").alias("evidence"))
    return found.unionByName(rest).unionByName(empty).select("doc_id", "source", F.col("evidence").isNotNull().alias("truncated"), "evidence")


def report(examined: DataFrame) -> DataFrame:
    """Per source: documents, truncated ones and their share."""
    return examined.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("truncated").alias("truncated")).withColumn("share", F.col("truncated") / F.col("documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return examine(table(spark, folder, "documents")).where("truncated").select("doc_id").dropDuplicates()


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return report(examine(table(spark, folder, "documents")))


QUERIES = {"p8_found": p8_found, "p8_report": p8_report}
SQL: dict[str, str] = {}
