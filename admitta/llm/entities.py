"""Matching records that name the same study programme without a shared key (problem 1).

A cascade of rules joins table rows to programmes. Every rule is an exact join on the faculty and a
combination of attributes, each weaker than the one before: all words of the name with level and
language, with one of them, with neither, then the beginnings of all words. Rows that a rule resolves
are taken out by an anti-join before the next one. The last rule joins what is left on parts of the
name (all but one beginning, three beginnings, all endings) and lets a word-by-word check decide.
Attributes that a rule doesn't join on must not contradict.

A rule's confidence is its smoothed precision on labelled records, those with a known program_id: a
bounded sample of them goes through the same cascade as rows whose programme is to be found, so each
rule is measured on what the rules before it leave over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.llm.fold import fold
from admitta.llm.canonical import name_words
from admitta.llm.lookalike import CONFUSABLE
from admitta.session import materialize
from admitta.sources.tables import table

#: How the three levels are written.
LEVELS = {"L": r"^(l|licenta|bachelor|studii (universitare )?de licenta|ciclul i)$", "M": r"^(m|master|masterat|studii (universitare )?de master|ciclul ii)$", "D": r"^(d|doctorat|phd|studii (universitare )?de doctorat|ciclul iii)$"}
#: Marks of the language of instruction inside names, in folded spelling.
LANGUAGES = {"en": r"\b(english|englez\w*|engl?\b|en\b)", "fr": r"\b(french|francais|francez\w*|fr\b)"}
ANY_FACULTY = "*"
#: Rule names, strongest first. The numbers of the rules are their places.
RULES = ("words, level and language", "words and level", "words and language", "words", "beginnings of all words", "alike word by word")
#: Letters of a beginning that stands for its word, and of the parts that only find candidates for the check.
BEGINNING, PART = 5, 3
#: Beginnings up to which a name gives all its triples; a longer one is found by each single beginning instead.
MOST_TRIPLED = 12
#: Labelled records that the rules' confidence is measured on.
LABELLED = 2000
#: Share of the words of a record without program_id that names with one must have.
KNOWN_SHARE = 0.5


def plain_name(name: Column) -> Column:
    """Broken lines joined, quotations, row numbers and counts of places left out."""
    text = F.regexp_replace(F.regexp_replace(name, r"-\s*\n\s*", ""), r"\s+", " ")
    text = F.regexp_replace(text, r"[„\"“][^”\"]*[”\"]", " ")
    return F.regexp_replace(text, r"^\s*\d+\s*[.)]\s*", "")


def level_of(level: Column, name: Column) -> Column:
    """L, M or D from the level or, where it is unknown, from the beginning of the name; else null."""
    said = F.trim(fold(level))
    out = F.lit(None).cast("string")
    for code, pattern in LEVELS.items():
        out = F.when(said.rlike(pattern), code).otherwise(out)
    start = fold(name)
    named = F.when(start.rlike(r"^\s*program de licenta"), "L").when(start.rlike(r"^\s*(program de )?master\w* "), "M").when(start.rlike(r"^\s*(scoala doctorala|program de doctorat)"), "D")
    return F.coalesce(out, named)


def language_of(language: Column, name: Column) -> Column:
    """en, fr or ro from the language or a mark in the name; null where neither tells."""
    mark = F.lit(None).cast("string")
    tail = fold(name, CONFUSABLE)
    for code, pattern in LANGUAGES.items():
        mark = F.when(tail.rlike(pattern), code).otherwise(mark)
    said = F.lower(F.trim(language))
    return F.coalesce(mark, F.when(said.startswith("engl"), "en").when(said.startswith("fr"), "fr").when(said.startswith("rom"), "ro"))


def faculty_of(slug: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.trim(slug)), r"[_\s]+", "-"), F.lit(""))


def subject_words(name: Column) -> Column:
    """Distinct content words of a name; misspelt joining words are left out."""
    return F.array_distinct(F.filter(name_words(plain_name(name)), lambda w: F.levenshtein(w["word"], F.lit("pentru")) > 2))


def similar(a: Column, b: Column) -> Column:
    """Words equal but for slips, or one the beginning of the other where it is an abbreviation or was cut."""
    x, y = a["word"], b["word"]
    shorter, edits = F.least(F.length(x), F.length(y)), F.levenshtein(x, y)
    slip = (edits <= 1) & (shorter >= 4) | (edits <= 2) & (shorter >= 6) | (edits <= 3) & (shorter >= 10)
    lx, ly = F.length(x), F.length(y)
    begins = (y.startswith(x) & (a["short"] | (lx <= 4))) | (x.startswith(y) & (b["short"] | (ly <= 4)))
    near = (a["short"] & (lx >= 4) & (F.levenshtein(x, F.substring(y, F.lit(1), lx)) <= 1)) | (b["short"] & (ly >= 4) & (F.levenshtein(y, F.substring(x, F.lit(1), ly)) <= 1))
    return (x == y) | slip | begins | near


def agrees(row: Column, programme: Column) -> Column:
    """Every word of the row has its counterpart, and at most one of four or more programme words has none.

    Words of up to three letters are cut words or slips of joining words and need no counterpart.
    """
    stray = F.filter(row, lambda w: (F.length(w["word"]) > 3) & ~F.exists(programme, lambda v: similar(w, v)))
    missing = F.filter(programme, lambda v: ~F.exists(row, lambda w: similar(w, v)))
    return (F.size(stray) == 0) & (F.size(missing) <= F.when(F.size(programme) >= 4, 1).otherwise(0))


def _codes(words: Column, size: int = PART, ends: bool = False) -> Column:
    long = F.filter(words, lambda w: F.length(w["word"]) > PART)
    return F.array_sort(F.array_distinct(F.transform(long, lambda w: F.right(w["word"], F.lit(size)) if ends else F.substring(w["word"], 1, size))))


def _triples(codes: Column) -> Column:
    n = F.size(codes)
    pick = lambda i: F.transform(F.sequence(i + 2, n), lambda k: F.struct(i.alias("i"), k.alias("k")))
    ends = F.flatten(F.transform(F.sequence(F.lit(1), n - 2), pick))
    return F.flatten(F.transform(ends, lambda e: F.transform(F.sequence(e["i"] + 1, e["k"] - 1), lambda j: F.array_join(F.array(F.get(codes, e["i"] - 1), F.get(codes, j - 1), F.get(codes, e["k"] - 1)), " "))))


def exact_key(rule: int, words: Column, level: Column, language: Column) -> Column:
    """The join key of a name under an exact rule; null where an attribute of the rule is unknown."""
    if rule == 4:
        codes = _codes(words, BEGINNING)
        return F.when(F.size(codes) > 0, F.array_join(codes, " "))
    text = F.array_join(F.array_sort(F.transform(words, lambda w: w["word"])), " ")
    return F.concat(text, *(F.concat(F.lit("|"), c) for c in ((level, language), (level,), (language,), ())[rule]))


def shared_parts(words: Column) -> Column:
    """Parts that names which may be alike word by word have in common, as hashes.

    All beginnings, all but one, three of them, and all endings. A name of more than ``MOST_TRIPLED``
    beginnings has no triples; see ``candidate_keys``.
    """
    codes, none = _codes(words), F.array().cast("array<string>")
    n, ends = F.size(codes), _codes(words, ends=True)
    some = lambda cond, keys: F.when(cond, keys).otherwise(none)
    all_but_one = F.transform(codes, lambda c: F.array_join(F.array_remove(codes, c), " "))
    parts = (some(n > 0, F.array(F.array_join(codes, " "))), some(n >= 2, all_but_one), some((n >= 3) & (n <= MOST_TRIPLED), _triples(codes)), some(F.size(ends) > 0, F.array(F.concat(F.lit("e:"), F.array_join(ends, " ")))))
    return F.array_distinct(F.transform(F.concat(*parts), lambda k: F.xxhash64(k)))


def candidate_keys(parts: Column, words: Column, is_row: bool) -> Column:
    """The parts, and for names without triples their single beginnings: a long name meets the other side at those, which every name gives for long names of the other side to find."""
    codes = _codes(words)
    mine, theirs = ("r:", "p:") if is_row else ("p:", "r:")
    tag = lambda mark: F.transform(codes, lambda c: F.xxhash64(F.concat(F.lit(mark), c)))
    return F.array_distinct(F.concat(parts, F.when(F.size(codes) > MOST_TRIPLED, tag(mine)).otherwise(F.array().cast("array<bigint>")), tag(theirs)))


def joined(rule: int, rows: DataFrame, programmes: DataFrame, any_faculty: bool) -> DataFrame:
    """(row_id, pid, row_lang, lang) of the pairs that a rule joins; for the last rule those that the check confirms.

    With ``any_faculty`` rows of that name look in all faculties. The last rule joins hashes of parts
    and ids only; each pair of a row and a name is then looked up and checked once.
    """
    attributes = [F.col(c).alias(f"row_{c}") for c in ("lvl", "lang", "ws")]
    if rule < len(RULES) - 1:
        key = exact_key(rule, F.col("ws"), F.col("lvl"), F.col("lang")).alias("key")
        left = rows.select("row_id", "own", "fac", *attributes[:2], key).where("key IS NOT NULL")
        right = programmes.select("pid", "fac", "lvl", "lang", "only_uid", key).where("key IS NOT NULL")
        if any_faculty:
            right = right.withColumn("fac", F.explode(F.array("fac", F.lit(ANY_FACULTY))))
        pairs = left.join(right, ["fac", "key"])
    else:
        keys = lambda is_row: F.explode(candidate_keys(F.col("parts"), F.col("ws"), is_row)).alias("key")
        left = rows.select("row_id", "fac", keys(True)) if "parts" in rows.columns else rows.withColumn("parts", shared_parts(F.col("ws"))).select("row_id", "fac", keys(True))
        right = programmes.select("name_id", "fac", keys(False))
        close = left.join(right, ["fac", "key"]).select("row_id", "name_id")
        if any_faculty:  # few rows, so the keys of all names are not written out again for them
            close = close.unionByName(left.where(F.col("fac") == ANY_FACULTY).select("row_id", "key").join(right, "key").select("row_id", "name_id"))
        close = close.dropDuplicates()
        pairs = close.join(programmes.select("name_id", "pid", "fac", "lvl", "lang", "ws", "only_uid"), "name_id")
        pairs = pairs.join(rows.select("row_id", "own", F.col("fac").alias("row_fac"), *attributes), "row_id").where((F.col("row_fac") == ANY_FACULTY) | (F.col("row_fac") == F.col("fac")))
    fits = F.coalesce(F.col("row_lvl") == F.col("lvl"), F.lit(True)) & F.coalesce(F.col("row_lang") == F.col("lang"), F.lit(True)) & ~F.coalesce(F.col("own") == F.col("only_uid"), F.lit(False))
    pairs = pairs.where(fits)
    if rule == len(RULES) - 1:
        pairs = pairs.where(agrees(F.col("row_ws"), F.col("ws")))
    return pairs.select("row_id", "pid", "row_lang", "lang")


def choose(found: DataFrame) -> DataFrame:
    """(row_id, pid): a row without a language mark means the programme in Romanian (or of untold language) where there is one."""
    plain = F.max(F.coalesce(F.col("lang") == "ro", F.lit(True))).over(Window.partitionBy("row_id"))
    foreign = F.col("row_lang").isNull() & F.col("_plain") & F.coalesce(F.col("lang") != "ro", F.lit(False))
    return found.withColumn("_plain", plain).where(~foreign).select("row_id", "pid").dropDuplicates()


def cascade(rows: DataFrame, programmes: DataFrame, any_faculty: bool = False) -> DataFrame:
    """(row_id, pid, rule): rule after rule over the rows that no stronger rule resolved.

    ``rows`` has row_id, own (a uid that must not be its own evidence, or null), fac, lvl, lang and ws;
    ``programmes`` has name_id, pid, fac, lvl, lang, ws, parts and only_uid (the uid that alone has these words, or null).
    """
    out = None
    for rule in range(len(RULES)):
        left = rows if out is None else rows.join(out.select("row_id"), "row_id", "left_anti")
        found = materialize(choose(joined(rule, left, programmes, any_faculty)).withColumn("rule", F.lit(rule)))
        out = found if out is None else out.unionByName(found)
    return out


def programme_records(programs: DataFrame) -> DataFrame:
    """(uid, program_id, fac, lvl, lang, ws, parts), one row per distinct record that names a programme of a faculty."""
    name = F.col("name")
    out = programs.select("uid", "program_id", faculty_of(F.col("faculty_slug")).alias("fac"), level_of(F.col("level"), name).alias("lvl"), language_of(F.col("language"), name).alias("lang"), subject_words(name).alias("ws"))
    return out.where("uid IS NOT NULL AND fac IS NOT NULL AND size(ws) > 0").dropDuplicates().withColumn("parts", shared_parts(F.col("ws")))


def paper_rows(pdf_rows: DataFrame, queue: DataFrame) -> DataFrame:
    """(row_id, pdf_url, row_idx, fac, lvl, lang, ws) of the rows that name a programme.

    The faculty comes from the queue; papers of ``rectorat`` may list programmes of any faculty, and
    papers of several faculties give a row for each.
    """
    owners = queue.select(F.coalesce("pdf_url", "url").alias("pdf_url"), faculty_of(F.col("faculty_slug")).alias("fac")).where("pdf_url IS NOT NULL AND fac IS NOT NULL")
    owners = owners.withColumn("fac", F.when(F.col("fac") == "rectorat", ANY_FACULTY).otherwise(F.col("fac"))).dropDuplicates()
    name = F.col("program_name")
    rows = pdf_rows.select("pdf_url", "row_idx", level_of(F.col("level"), F.lit(None).cast("string")).alias("lvl"), language_of(F.lit(None).cast("string"), F.regexp_replace(name, r"-\s*\n\s*", "")).alias("lang"), subject_words(name).alias("ws"))
    rows = rows.where("pdf_url IS NOT NULL AND row_idx IS NOT NULL AND size(ws) > 0").dropDuplicates()
    return rows.join(owners, "pdf_url").withColumn("row_id", F.unhex(F.md5(F.concat_ws("#", F.col("row_idx"), F.col("pdf_url")))))


def programmes_of(records: DataFrame) -> DataFrame:
    """(name_id, pid, fac, lvl, lang, ws, parts, only_uid) from records (uid, pid, fac, lvl, lang, ws, parts), kept.

    Level and language told by any record of a programme hold for all its names.
    """
    foreign = F.struct(F.coalesce(F.col("lang") != "ro", F.lit(False)).alias("foreign"), F.col("lang").alias("lang"))
    told = records.groupBy("pid").agg(F.max("lvl").alias("lvl"), F.max(foreign)["lang"].alias("lang"))
    names = records.groupBy("pid", "fac", "ws").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"), F.first("parts").alias("parts"))
    return materialize(names.join(told, "pid").select(F.monotonically_increasing_id().alias("name_id"), "pid", "fac", "lvl", "lang", "ws", "parts", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("only_uid")))


def like_programmes(lone: DataFrame, known: DataFrame) -> DataFrame:
    """Records without program_id whose longer words are, for ``KNOWN_SHARE`` at least, words of names with one.

    Headings and navigation texts of the pages have no program_id and other words.
    """
    long = lambda df: df.select("row_id", F.explode(F.filter(F.transform("ws", lambda w: w["word"]), lambda w: F.length(w) > PART)).alias("w"))
    words = known.select(F.explode("ws.word").alias("w")).dropDuplicates().withColumn("hit", F.lit(1))
    share = long(lone).join(words, "w", "left").groupBy("row_id").agg((F.count("hit") / F.count(F.lit(1))).alias("share")).where(F.col("share") >= KNOWN_SHARE)
    return lone.join(share.select("row_id"), "row_id", "left_semi")


def rule_confidence(found: DataFrame, weight: float = 4.0) -> DataFrame:
    """(rule, joined_pairs, right_pairs, confidence) from pairs (rule, pid, program_id) of labelled rows.

    The precision of all pairs, itself smoothed by one right and one wrong pair, counts as ``weight``
    more pairs of each rule. A rule is never surer than a stronger one.
    """
    right = F.col("pid") == F.col("program_id")
    seen = found.groupBy("rule").agg(F.count(F.lit(1)).alias("joined_pairs"), F.count_if(right).alias("right_pairs"))
    every = found.sparkSession.range(len(RULES)).select(F.col("id").cast("int").alias("rule")).join(seen, "rule", "left").fillna(0)
    # one row per rule
    every_rule = Window.partitionBy()
    pooled = (F.sum("right_pairs").over(every_rule) + 1.0) / (F.sum("joined_pairs").over(every_rule) + 2.0)
    sure = every.withColumn("confidence", (F.col("right_pairs") + pooled * weight) / (F.col("joined_pairs") + weight))
    return sure.withColumn("confidence", F.min("confidence").over(every_rule.orderBy("rule").rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def match_programmes(programs: DataFrame, pdf_rows: DataFrame, queue: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(uid, pdf_url, row_idx, rule, confidence): one row per pair that means the same programme.

    Records that share a program_id stand for one programme; records without one are first attached
    to the programmes by the same cascade, or stand for themselves. Nulls in key columns, texts that
    name no programme and papers that no faculty owns give no row; repeated rows give one. ``rule`` is
    the strongest rule that joined the pair, and ``confidence`` is that rule's.
    """
    records = materialize(programme_records(programs))
    known = records.where("program_id IS NOT NULL").withColumn("pid", F.col("program_id"))
    named = programmes_of(known)
    ided = lambda df, kind: df.withColumn("row_id", F.unhex(F.md5(F.to_json(F.struct(F.lit(kind), "uid", "ws", "fac", "lvl", "lang")))))
    lone = like_programmes(ided(records.where("program_id IS NULL"), "lone"), named)
    # records whose programme has others to be found by, as a paper would show them: a language that is not marked is Romanian
    several = known.groupBy("pid").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo <> hi").select("pid")
    sample = ided(known.join(several, "pid", "left_semi").orderBy(F.xxhash64("uid", "ws"), "uid").limit(labelled), "labelled")
    cols = ("row_id", "uid", "program_id", "fac", "lvl", "ws", "parts")
    tested = materialize(lone.select(*cols, "lang").unionByName(sample.select(*cols, F.nullif("lang", F.lit("ro")).alias("lang"))))
    found = cascade(tested.select("row_id", F.col("uid").alias("own"), "fac", "lvl", "lang", "ws", "parts"), named)
    homes = found.join(tested.select("row_id", "uid", "program_id").dropDuplicates(), "row_id")
    sure = materialize(rule_confidence(homes.where("program_id IS NOT NULL")))
    attached = homes.where("program_id IS NULL").select("uid", F.col("pid").alias("home"))
    alone = tested.where("program_id IS NULL").join(attached, "uid", "left").withColumn("pid", F.coalesce("home", F.concat(F.lit("uid:"), F.col("uid"))))
    cols = ("uid", "pid", "fac", "lvl", "lang", "ws", "parts")
    everyone = materialize(known.select(*cols).unionByName(alone.select(*cols)))
    rows = materialize(paper_rows(pdf_rows, queue))
    pairs = cascade(rows.withColumn("own", F.lit(None).cast("string")), programmes_of(everyone), any_faculty=True)
    pairs = pairs.join(rows.select("row_id", "pdf_url", "row_idx").dropDuplicates(), "row_id").join(everyone.select("uid", "pid").dropDuplicates(), "pid")
    best = pairs.groupBy("uid", "pdf_url", "row_idx").agg(F.min("rule").alias("rule"))
    return best.join(F.broadcast(sure.select("rule", "confidence")), "rule").select("uid", "pdf_url", "row_idx", "rule", "confidence")  # one row per rule


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_matches(spark, folder).select("uid", "pdf_url", "row_idx")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    return match_programmes(table(spark, folder, "programs"), table(spark, folder, "pdf_rows"), table(spark, folder, "pdf_queue"))


QUERIES = {"p1_found": p1_found, "p1_matches": p1_matches}
SQL: dict[str, str] = {}
