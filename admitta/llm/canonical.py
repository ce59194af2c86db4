"""Mapping freely written names to a reference list (problem 3).

The reference names are taken apart into words; a name means the entry whose words it has, in any
order and in either language, after slips are allowed for. Words are resolved with a partition-based
similarity join: a reference string cut into k + 1 segments keeps one of them whole under k edits, at
a position shifted by at most k, so an equality join on positional substrings finds every candidate,
and the built-in levenshtein verifies it. Only the distinct words of the data take part. Names whose
words fit no entry are reported through an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.llm.fold import fold
from admitta.llm.lookalike import CONFUSABLE
from admitta.sources.tables import table

#: Words that only remark on a programme or join its parts.
REMARKS = [
    "studii", "de", "programul", "program", "programe", "specializarea", "specializare", "domeniul", "domeniu", "licenta", "licență", "master", "masterat",
    "doctorat", "scoala", "doctorala", "in", "din", "pentru", "la", "cu", "si", "and", "of", "the", "prog", "frecventa", "if", "ifr", "id", "zi", "nou",
    "noua", "an", "anul", "locuri", "buget", "taxa", "fara", "limba", "lb", "engleza", "engl", "eng", "en", "english", "predare", "integral", "sesiune",
]
#: Shortest prefix of a reference word that an abbreviation may be.
MIN_ABBREVIATION = 4
#: Edits searched for by length of the reference string, from this length on.
SEARCHED = ((7, 3), (4, 2), (0, 0))
#: Edits allowed by length, and edits allowed where at most so many letters differ at all:
#: a swap of neighbours is two edits, though no letter differs.
ALLOWED = ((12, 3), (7, 2), (4, 1), (0, 0))
REORDERED = ((7, 3, 1), (4, 2, 0))
MOST_EDITS = 3
#: Choices of one target per word that are written out; names with more are compared with each entry of their length.
MOST_CHOICES = 1000


def _by_length(length: Column, steps: tuple[tuple[int, int], ...]) -> Column:
    out = F.lit(0)
    for least, k in reversed(steps):
        out = F.when(length >= least, F.lit(k)).otherwise(out)
    return out


def letters_differing(a: Column, b: Column) -> Column:
    """Letters of one word that the other lacks, on the side that lacks more."""
    more = less = F.lit(0)
    for c in "abcdefghijklmnopqrstuvwxyz":
        gap = F.length(F.replace(b, F.lit(c), F.lit(""))) - F.length(b) - F.length(F.replace(a, F.lit(c), F.lit(""))) + F.length(a)
        more, less = more + F.greatest(gap, F.lit(0)), less + F.greatest(-gap, F.lit(0))
    return F.greatest(more, less)


def close_enough(word: Column, ref: Column, edits: Column) -> Column:
    length = F.length(ref)
    ok = edits <= _by_length(length, ALLOWED)
    for least, most, letters in REORDERED:
        ok = ok | ((length >= least) & (edits <= most) & (letters_differing(word, ref) <= letters))
    return ok


def name_words(name: Column) -> Column:
    """array<struct<word, short>> of the content words; ``short`` marks abbreviations ended by a full stop.

    Text in brackets, numbers, words of another alphabet and remarks are left out.
    """
    plain = F.regexp_replace(fold(name, CONFUSABLE), r"\([^)]*\)|\[[^\]]*\]", " ")
    parts = F.regexp_extract_all(plain, F.lit(r"([\p{L}\p{N}]+\.?)"), F.lit(1))
    words = F.transform(parts, lambda w: F.struct(F.rtrim(w, F.lit(".")).alias("word"), (w.endswith(".") & (F.length(w) > MIN_ABBREVIATION)).alias("short")))
    return F.filter(words, lambda w: w["word"].rlike("^[a-z]+$") & (F.length(w["word"]) > 1) & ~w["word"].isin(REMARKS))


def catalog_words(catalog: DataFrame) -> DataFrame:
    """(catalog_id, lang, words): the sorted content words of each name of each entry."""
    names = F.explode(F.array(F.struct(F.lit("ro").alias("lang"), F.col("name").alias("n")), F.struct(F.lit("en").alias("lang"), F.col("name_en").alias("n"))))
    rows = catalog.select("catalog_id", names.alias("x")).select("catalog_id", "x.lang", F.array_sort(F.transform(name_words(F.col("x.n")), lambda w: w["word"])).alias("words"))
    return rows.where("catalog_id IS NOT NULL AND size(words) > 0").dropDuplicates(["catalog_id", "words"])


def reference_strings(entries: DataFrame) -> DataFrame:
    """(ref, target, lang, short): the words themselves, and their prefixes as possible abbreviations."""
    words = entries.select("lang", F.explode("words").alias("target")).dropDuplicates()
    whole = words.select(F.col("target").alias("ref"), "target", "lang", F.lit(False).alias("short"))
    cut = words.where(F.length("target") > MIN_ABBREVIATION).select(
        F.explode(F.transform(F.sequence(F.lit(MIN_ABBREVIATION), F.length("target")), lambda n: F.substring("target", 1, n))).alias("ref"), "target", "lang", F.lit(True).alias("short")
    )
    return whole.unionByName(cut)


def _segment(text: Column, length: Column, k: Column, i: Column, shift: Column) -> Column:
    """Segment ``i`` of k + 1 of a string of ``length``, read from ``text`` ``shift`` further on."""
    begin = F.floor(length * i / (k + 1)).cast("int")
    size = F.floor(length * (i + 1) / (k + 1)).cast("int") - begin
    return F.when(begin + shift >= 0, F.substring(text, begin + shift + 1, size)).otherwise(F.lit(""))


def similar_words(words: DataFrame, refs: DataFrame) -> DataFrame:
    """(word, short, lang, target, edits): for each word the closest targets of each language, within the edits allowed.

    ``words`` (word, short) must be distinct. A reference string of length L is cut into k + 1
    segments; segment i of a word that is within k edits and longer by d lies at a shift between
    max(-i, d - (k - i)) and min(i, d + (k - i)). A word of a language means only itself there.
    """
    cut = refs.withColumn("len", F.length("ref")).withColumn("k", _by_length(F.col("len"), SEARCHED))
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    cut = cut.select("ref", "target", "lang", F.col("short").alias("ref_short"), "len", "i", _segment(F.col("ref"), F.col("len"), F.col("k"), F.col("i"), F.lit(0)).alias("piece"))
    n = F.length("word")
    probe = words.withColumn("len", F.explode(F.sequence(F.greatest(F.lit(1), n - MOST_EDITS), n + MOST_EDITS))).withColumn("k", _by_length(F.col("len"), SEARCHED))
    probe = probe.where(F.abs(n - F.col("len")) <= F.col("k")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    low = F.greatest(-F.col("i"), n - F.col("len") - F.col("k") + F.col("i"))
    high = F.least(F.col("i"), n - F.col("len") + F.col("k") - F.col("i"))
    probe = probe.where(low <= high).withColumn("s", F.explode(F.sequence(low, high)))
    probe = probe.select("word", "short", "len", "i", _segment(F.col("word"), F.col("len"), F.col("k"), F.col("i"), F.col("s")).alias("piece"))
    found = probe.join(cut, (probe["piece"] == cut["piece"]) & (probe["len"] == cut["len"]) & (probe["i"] == cut["i"]) & (probe["short"] == cut["ref_short"]))
    checked = found.select("word", "short", "lang", "target", "ref").dropDuplicates().withColumn("edits", F.levenshtein("word", "ref"))
    near = checked.where(close_enough(F.col("word"), F.col("ref"), F.col("edits"))).groupBy("word", "short", "lang", "target").agg(F.min("edits").alias("edits"))
    least = F.min("edits").over(Window.partitionBy("word", "short", "lang"))
    return near.withColumn("_least", least).where("edits = _least").drop("_least")


def _choices(places: Column) -> Column:
    """Every choice of one target per place, with the sum of the edits."""
    start = F.array(F.struct(F.array().cast("array<string>").alias("t"), F.lit(0).alias("e")))
    return F.aggregate(places, start, lambda acc, p: F.flatten(F.transform(acc, lambda a: F.transform(p["o"], lambda o: F.struct(F.concat(a["t"], F.array(o["target"])).alias("t"), (a["e"] + o["edits"]).alias("e"))))))


def map_names(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """(origin, record_key, catalog_id, edits) of the records whose name means an entry.

    ``records`` has origin, record_key and name. All content words of a name must resolve to the words
    of one entry, each to another; the fewest edits win, then the smaller catalog_id. Null, empty and
    wordless names mean nothing. Work is done once per distinct list of words.
    """
    entries = catalog_words(catalog)
    named = records.select("origin", "record_key", F.col("name").alias("_n")).where("record_key IS NOT NULL AND _n IS NOT NULL").dropDuplicates()
    worded = named.select("origin", "record_key", F.array_sort(name_words(F.col("_n"))).alias("ws")).where("size(ws) > 0")
    # entries have few words, and no name of more words can mean one
    longest = entries.agg(F.max(F.size("words"))).first()[0] or 0
    worded = worded.where(F.size("ws") <= longest)
    lists = worded.select("ws").dropDuplicates()
    each = lists.select("ws", F.posexplode("ws").alias("pos", "w")).select("ws", "pos", "w.word", "w.short")
    resolved = similar_words(each.select("word", "short").dropDuplicates(), reference_strings(entries))
    options = each.join(resolved, ["word", "short"])
    # every choice of one target per position, as a sorted list, is looked up among the entries' lists
    places = options.groupBy("ws", "lang", "pos").agg(F.collect_set(F.struct("target", F.col("edits").cast("int").alias("edits"))).alias("o"))
    whole = places.groupBy("ws", "lang").agg(F.array_sort(F.collect_list(F.struct("pos", "o"))).alias("ps")).where(F.size("ps") == F.size("ws"))
    choices = F.aggregate("ps", F.lit(1.0), lambda acc, p: acc * F.size(p["o"]))
    few = whole.where(choices <= MOST_CHOICES).select("ws", "lang", F.explode(_choices(F.col("ps"))).alias("c")).select("ws", "lang", F.array_sort("c.t").alias("words"), F.col("c.e").alias("edits"))
    listed = entries.withColumn("n", F.size("words"))
    # of many choices only those among the words of one entry
    many = whole.where(choices > MOST_CHOICES).withColumn("n", F.size("ws")).join(listed, ["lang", "n"])
    many = many.withColumn("ps", F.transform("ps", lambda p: F.struct(p["pos"].alias("pos"), F.filter(p["o"], lambda o: F.array_contains(F.col("words"), o["target"])).alias("o"))))
    many = many.where(F.forall("ps", lambda p: F.size(p["o"]) > 0)).select("ws", "lang", F.explode(_choices(F.col("ps"))).alias("c")).select("ws", "lang", F.array_sort("c.t").alias("words"), F.col("c.e").alias("edits"))
    whole = few.unionByName(many).join(entries, ["lang", "words"])
    first = Window.partitionBy("ws").orderBy("edits", "catalog_id")
    meant = whole.withColumn("place", F.row_number().over(first)).where("place = 1").select("ws", "catalog_id", "edits")
    return worded.join(meant, "ws").select("origin", "record_key", "catalog_id", "edits").dropDuplicates(["origin", "record_key", "catalog_id"])


def records_of(firecrawl: DataFrame, programs: DataFrame) -> DataFrame:
    typed = firecrawl.select(F.lit("firecrawl").alias("origin"), F.col("firecrawl_id").cast("string").alias("record_key"), "name")
    return typed.unionByName(programs.select(F.lit("programs").alias("origin"), F.col("uid").alias("record_key"), "name"))


def unmatched(records: DataFrame, mapped: DataFrame) -> DataFrame:
    """(origin, record_key, name) of the records that mean no entry."""
    keys = mapped.select("origin", "record_key").dropDuplicates()
    return records.select("origin", "record_key", "name").dropDuplicates().join(keys, ["origin", "record_key"], "left_anti")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    records = records_of(table(spark, folder, "firecrawl"), table(spark, folder, "programs"))
    return map_names(records, table(spark, folder, "program_catalog")).select("origin", "record_key", "catalog_id")


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    records = records_of(table(spark, folder, "firecrawl"), table(spark, folder, "programs"))
    return unmatched(records, map_names(records, table(spark, folder, "program_catalog")))


QUERIES = {"p3_found": p3_found, "p3_unmatched": p3_unmatched}
SQL: dict[str, str] = {}
