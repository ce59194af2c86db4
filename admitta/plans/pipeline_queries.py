"""Queries on validation, ranking, aggregation, matching, fusion and publishing, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.functions import fuzzy, identity, parse
from admitta.functions.vocab import (
    AGAINST, CAREERS_ALL, CAREERS_FIRST, COUNT_PATTERN, BUDGET_PATTERN, DOCUMENT_TYPES, LIST_NOISE_MORE, LIST_WHITELIST, NEGATIVE, NO_CAREER, NOISE_PATTERN, POSITIVE, ROW_BLACKLIST, SUFFIXES, TAX_PATTERN,
)
from admitta.operators import boilerplate, coverage, fuse, grades, html, match, publish, rank, validate
from admitta.plans.ratio_sql import ratios as sql_ratios
from admitta.plans.text_queries import DIA, SQL_DISPLAY, SQL_IS_TITLE, sql_comparable, sql_match_form, sql_slug
from admitta.sources.tables import table
from admitta.streaming import breaker

YEAR = 2026
#: Stable ids of published records begin with it.
PREFIX = "uni"


def _programs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "programs").select(*columns).dropDuplicates()


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pdf_rows").dropDuplicates()


def _paired(spark: SparkSession, folder: str) -> DataFrame:
    """Table rows with the faculty of their paper, from the queue."""
    owners = table(spark, folder, "pdf_queue").select(F.coalesce("pdf_url", "url").alias("pdf_url"), F.lower("faculty_slug").alias("faculty_slug")).where("pdf_url IS NOT NULL").dropDuplicates()
    return _rows(spark, folder).join(owners, "pdf_url")


# validation


def name_validation(spark: SparkSession, folder: str) -> DataFrame:
    return _programs(spark, folder, "uid", "name").withColumn("c", validate.name_check(F.col("name"))).select("uid", "c.status", "c.score", "c.reason")


def row_validation(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, "uid", "name", "program_id", "admission_year", "spots_budget", "spots_tax", "source_type", "accuracy_confidence", F.col("evidence")["spots"].alias("spots"))
    names = ("name", "program_id", "admission_year", "spots_budget", "spots_tax", "spots", "source_type", "accuracy_confidence")
    cols = {n: F.col(n) for n in names} | {"accuracy_confidence": F.nanvl("accuracy_confidence", F.lit(None).cast("double"))}
    checked = p.select(
        "uid", validate.hygiene_check(cols["name"]).alias("h"), validate.identifier_check(cols["program_id"], cols["admission_year"]).alias("i"),
        validate.spots_check(cols["spots_budget"], cols["spots_tax"], cols["spots"], cols["source_type"], cols["accuracy_confidence"]).alias("s"), validate.row_check(*(cols[n] for n in names)).alias("r"),
    )
    return checked.select("uid", F.col("h.reason").alias("hygiene"), F.col("i.reason").alias("identifiers"), F.col("s.status").alias("spots"), F.col("r.status").alias("status"), F.col("r.reason").alias("reason")).dropDuplicates()


def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = validate.split_by_name(_rows(spark, folder), "program_name")
    passed, held, failed = (p.select("pdf_url", "row_idx", "program_name", F.col("check.status").alias("status"), F.col("check.reason").alias("reason")) for p in parts)
    return passed.unionAll(held).unionAll(failed)


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    _, held, _ = validate.split_by_name(_rows(spark, folder), "program_name")
    return publish.quarantine(held).select("key", "name", "reason", "score")


def list_items(spark: SparkSession, folder: str) -> DataFrame:
    return _programs(spark, folder, "spots_raw").where("spots_raw IS NOT NULL").select("spots_raw", html.accepts_item(F.col("spots_raw")).alias("accepted"))


def published(spark: SparkSession, folder: str) -> DataFrame:
    g = publish.gold(publish.flat(table(spark, folder, "programs")))
    return g.select("program_name", "faculty_code", "level", F.col("spots.budget").alias("budget"), F.col("spots.tax").alias("tax"), F.col("metadata.confidence").alias("confidence"), F.col("metadata.url").alias("url")).dropDuplicates()


# ranking


def _ranked(target: str):
    return lambda spark, folder: rank.ranked_queue(table(spark, folder, "pdf_queue").dropDuplicates(["input_pos"]), YEAR, target).select("input_pos", "faculty_slug", "stage_a_score", "place")


def best_papers(spark: SparkSession, folder: str) -> DataFrame:
    return rank.best_papers(table(spark, folder, "pdf_queue").dropDuplicates(["input_pos"]), YEAR).select("input_pos", "faculty_slug", "stage_a_score", "place")


def grade_links(spark: SparkSession, folder: str) -> DataFrame:
    q = table(spark, folder, "pdf_queue").dropDuplicates(["input_pos"]).where("link_text IS NOT NULL")
    return q.select("input_pos", rank.grade_link_score(F.col("link_text"), F.coalesce("pdf_url", "url", F.lit(""))).alias("score")).where("score > 0")


def paper_contents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a source as the pages of one paper, in the order of their ids."""
    docs = table(spark, folder, "documents").select(F.concat_ws("/", "source", "faculty_slug").alias("pdf_url"), "doc_id", "text")
    first = docs.withColumn("page_no", F.expr("row_number() OVER (PARTITION BY pdf_url ORDER BY doc_id)")).where("page_no <= 2")
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: F.contains(x, F.lit("|"))), lambda x: F.split(x, r"\|"))
    numbered = first.withColumn("tables", F.when(F.size(lines) > 0, F.array(lines)))
    return rank.content_score(numbered, YEAR).select("pdf_url", "text_density", "has_table", "rows_with_numbers", "detected_year", "content_score")


def trusted(spark: SparkSession, folder: str) -> DataFrame:
    return rank.trusted_papers(_rows(spark, folder))


# aggregation and windows


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.page_lines(table(spark, folder, "documents").where("text IS NOT NULL"), "source", "doc_id", "text")


def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.repeated_lines(_lines(spark, folder), 0.02).select(F.col("g").alias("source"), "line", "pages", "all_pages")


def without_repeated(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return boilerplate.without_repeated(lines, boilerplate.repeated_lines(lines, 0.02)).select(F.col("p").alias("doc_id"), F.md5("text").alias("text_md5"))


def lowest_grades(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, "uid", F.lower("faculty_slug").alias("faculty_slug"), F.nanvl("last_admission_grade", F.lit(None).cast("double")).alias("grade"))
    return grades.lowest_grades(p, ["faculty_slug"])


def merged_grades(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, "uid", "run_id", F.lower("faculty_slug").alias("faculty_slug"), F.nanvl("last_admission_grade", F.lit(None).cast("double")).alias("grade"))
    return grades.merged_grades(grades.lowest_grades(p, ["faculty_slug", "run_id"]), ["faculty_slug"], "run_id")


def filled_levels(spark: SparkSession, folder: str) -> DataFrame:
    r = _rows(spark, folder).dropDuplicates(["pdf_url", "row_idx"])
    return r.select("pdf_url", "row_idx", boilerplate.fill_forward(F.col("page"), ["pdf_url"], ["row_idx"]).alias("page"), boilerplate.first_known(F.col("page"), ["pdf_url"], ["row_idx"]).alias("first_page"))


def progress(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.progress(table(spark, folder, "faculties"), "pos").select("slug", "progress").orderBy("slug")


def truth(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "firecrawl").select(F.col("firecrawl_id").alias("key"), "name", "level")


def coverage_exact(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.coverage(coverage.exact_hits(truth(spark, folder), table(spark, folder, "program_catalog").select("name")), "level")


def coverage_contained(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.containment_hits(truth(spark, folder), table(spark, folder, "programs").select("name"))


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.run_summary(table(spark, folder, "pdf_queue"), F.coalesce(F.col("status") == "done", F.lit(False)))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "pdf_queue").select(F.lower("faculty_slug").alias("faculty_slug"), F.when(F.col("status") == "done", "OK").otherwise("ERROR").alias("status"))
    m = publish.manifest(o, "run", "2026-01-01", "2026-01-02")
    return m.select("run_id", "faculties_total", F.array_join("successful", ",").alias("successful"))


def first_seen(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.first_seen(table(spark, folder, "pdf_queue")).select("input_pos", "address")


def write_back(spark: SparkSession, folder: str) -> DataFrame:
    q = table(spark, folder, "pdf_queue").dropDuplicates(["input_pos"])
    waiting = q.where("status IN ('queued', 'pending') AND coalesce(pdf_url, url) IS NOT NULL").select(F.coalesce("pdf_url", "url").alias("address"), F.col("input_pos").alias("seq"), F.lit("downloaded").alias("status"), identity.pdf_name(F.coalesce("pdf_url", "url"), "spots").alias("local_path"))
    return coverage.write_back(q, waiting).select("input_pos", "status", "local_path")


def domain_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = {"all": ["example"], "main": ["corveni.example", "central.example"]}
    q = table(spark, folder, "pdf_queue").select("input_pos", F.coalesce("pdf_url", "url").alias("address")).where("address IS NOT NULL").dropDuplicates()
    return q.select("input_pos", "address", coverage.domain_group(F.col("address"), groups).alias("longest"), coverage.domain_group(F.col("address"), groups, False).alias("first"))


def set_operations(spark: SparkSession, folder: str) -> DataFrame:
    a, b = table(spark, folder, "programs").select(F.lower("faculty_slug").alias("s")), table(spark, folder, "pdf_queue").select(F.lower("faculty_slug").alias("s"))
    both, only, either = a.intersect(b), a.exceptAll(a.intersect(b)).select("s").distinct().subtract(b), a.union(b).distinct()
    return both.select(F.lit("both").alias("kind"), "s").unionAll(only.select(F.lit("only").alias("kind"), "s")).unionAll(either.select(F.lit("either").alias("kind"), "s"))


def hash_changes(spark: SparkSession, folder: str) -> DataFrame:
    """ST5 on two versions of the documents: the later one has other texts and misses some."""
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("key"), "text", "admission_year")
    old = d.where("admission_year IS NULL OR admission_year <> 2025").select("key", identity.content_hash(F.col("text")).alias("h_old"), F.lit(True).alias("o"))
    new = d.where("admission_year IS NULL OR admission_year >= 2025").select("key", identity.content_hash(F.when(F.col("text").endswith("."), F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h_new"), F.lit(True).alias("n"))
    kind = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "removed").when(F.col("h_old") != F.col("h_new"), "changed").otherwise("same")
    return old.join(new, "key", "full_outer").select("key", kind.alias("kind"))


# matching


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Programmes and rows of papers; a row stands once with each faculty that lists its paper."""
    p = _programs(spark, folder, F.col("uid").alias("pid"), "name", "level", "domain", F.lower("faculty_slug").alias("faculty_slug"))
    r = _paired(spark, folder).select(F.concat_ws("#", "pdf_url", "row_idx").alias("rid"), "program_name", "level", "domain", "faculty_slug").dropDuplicates()
    return p, r


def fuzzy_match(spark: SparkSession, folder: str) -> DataFrame:
    return match.best_rows(*_sides(spark, folder), ["faculty_slug"]).withColumn("score", F.round("score", 6)).drop("faculty_slug")


def ratios(spark: SparkSession, folder: str) -> DataFrame:
    """X1 to X3 of each record's name and the line it was read from."""
    p = _programs(spark, folder, "uid", match.comparable(F.col("name")).alias("a"), match.comparable(F.col("spots_raw")).alias("b"))
    return p.select("uid", *(F.round(f("a", "b"), 6).alias(n) for n, f in (("token_set", fuzzy.token_set), ("partial", fuzzy.partial), ("indel", fuzzy.indel)))).dropDuplicates()


def grade_match(spark: SparkSession, folder: str) -> DataFrame:
    """Grades by the names of the faculty's table rows; the funded places stand in for the mark."""
    p, _ = _sides(spark, folder)
    r = _paired(spark, folder)
    marks = r.groupBy("faculty_slug", F.col("program_name").alias("grade_key")).agg((F.lit(5.0) + F.least(F.coalesce(F.min("spots_budget"), F.lit(0)), F.lit(50)) / 10.0).alias("min_grade"), F.min(F.concat_ws("#", "pdf_url", "row_idx")).alias("key_pos"))
    return match.grade_matches(p, marks.where("grade_key IS NOT NULL"), ["faculty_slug"]).withColumn("alike", F.round("alike", 6))


# fusion


def _matches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that have the name of a programme of their faculty, with a match score that depends on the paper's place."""
    p = _programs(spark, folder, "uid", "name", F.lower("faculty_slug").alias("faculty_slug")).select("uid", "faculty_slug", match.comparable(F.col("name")).alias("form"))
    r = _paired(spark, folder).withColumn("form", match.comparable(F.col("program_name"))).dropDuplicates(["pdf_url", "row_idx", "faculty_slug"])
    return p.join(r, ["faculty_slug", "form"]).withColumn("match_score", 1.0 - F.col("pdf_rank") / 100.0)


def evidence(spark: SparkSession, folder: str) -> DataFrame:
    items = fuse.collect_evidence(_matches(spark, folder), ["uid"])
    said = F.transform("spots_evidence", lambda e: F.concat_ws("/", e["source"], e["value"]["budget"], e["value"]["tax"], e["page"], e["snippet"]))
    return items.select("uid", F.size("spots_evidence").cast("long").alias("n_items"), F.array_join(said, "|").alias("items"))


def arbitration(spark: SparkSession, folder: str) -> DataFrame:
    return fuse.arbitrate(_matches(spark, folder), ["uid"]).select("uid", "pdf_url", "row_idx", "spots_budget", "spots_tax", F.round("best_source_score", 6).alias("best_source_score"), "accuracy_confidence")


def faculty_uids(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "faculties").select("slug", F.sha2(F.concat(F.lit("listed:"), F.col("slug")), 256).alias("uid"))
    p = _programs(spark, folder, F.col("uid").alias("program_uid"), "faculty_slug")
    return fuse.with_faculty_uid(p, f).select("program_uid", "resolved_faculty_uid")


def faculty_names(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, F.col("uid").alias("program_uid"), "faculty_slug")
    return fuse.with_faculty_name(p, table(spark, folder, "faculties")).select("program_uid", "faculty_name")


def from_papers(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs").select(F.lower("faculty_slug").alias("faculty_slug"))
    return fuse.programmes_from_papers(_paired(spark, folder), p)


def narratives(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, "uid", "name", "level", "faculty_slug", "spots_budget", "spots_tax", "source_url", F.nanvl("last_admission_grade", F.lit(None).cast("double")).alias("g"))
    t = fuse.narrative(F.col("name"), F.col("level"), F.col("faculty_slug"), F.col("spots_budget"), F.col("spots_tax"), F.col("source_url"), publish.first_careers(F.col("name")))
    return p.select("uid", F.md5(t).alias("text_md5"), fuse.with_grade_line(F.lit("x"), F.col("g"), YEAR).alias("grade_line"))


def flat_export(spark: SparkSession, folder: str) -> DataFrame:
    f = publish.flat(table(spark, folder, "programs"))
    return f.withColumn("last_admission_grade", F.nanvl("last_admission_grade", F.lit(None).cast("double")))


def careers(spark: SparkSession, folder: str) -> DataFrame:
    n = _programs(spark, folder, "uid", "name")
    return n.select("uid", F.array_join(publish.first_careers(F.col("name")), ",").alias("first_careers"), F.array_join(publish.all_careers(F.col("name")), ",").alias("all_careers"))


def retrieval(spark: SparkSession, folder: str) -> DataFrame:
    r = publish.retrieval_text(table(spark, folder, "programs"), YEAR, PREFIX).dropDuplicates()
    return r.select("uid", "program_id", "language", F.array_join("keywords", ",").alias("keywords"), F.array_join("career_paths", ",").alias("career_paths"), "text_for_embedding")


def requirements(spark: SparkSession, folder: str) -> DataFrame:
    p = _programs(spark, folder, "uid", "level", "source_type", "spots_budget")
    return p.select("uid", "level", F.array_join(publish.requirements(F.col("level")), ",").alias("requirements"), fuse.extraction_confidence(F.col("source_type"), F.col("spots_budget")).alias("confidence")).dropDuplicates()


def upserted(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs").select("uid", "run_id", F.col("scraped_at").alias("seq"), "name").dropDuplicates(["uid"])
    s = table(spark, folder, "program_snapshots").select(F.lower(F.trim("uid")).alias("uid"), "run_id", F.col("scraped_at").alias("seq"), "name")
    return publish.upsert(s, p).select("uid", "run_id", "seq")


# breakers


def breaker_table(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", F.col("user_id").cast("string").alias("key"), "ts", (F.col("event_type") != "error").alias("ok"))
    return breaker.failures_in_a_row(e, "key", ["ts", "event_id"], "ok", F.date_trunc("day", "ts")).select("event_id", "failures", (F.col("failures") >= 3).alias("open"))


def breaker_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The stream reader over the events file, run to its end; the result is kept as a table in the shared folder."""
    from admitta.session import shared_path

    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    e = raw.select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") != "error").alias("ok"))
    out = shared_path(spark, "breaker")
    q = breaker.breaker_states(e).writeStream.format("parquet").option("checkpointLocation", shared_path(spark, "breaker-state")).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(breaker.OUT).parquet(out)


QUERIES = {
    "f1_name_validation": name_validation, "f2_to_f5_row_validation": row_validation, "f1_quarantine_split": quarantine_split, "sk6_quarantine": quarantined, "f7_list_items": list_items, "e2_f10_published": published,
    "e14_ranked_spots": _ranked("SPOTS"), "e14_ranked_results": _ranked("RESULTS"), "o2_best_papers": best_papers, "f13_grade_links": grade_links, "e15_paper_contents": paper_contents, "f15_trusted_papers": trusted,
    "a2_repeated_lines": repeated_lines, "a3_without_repeated": without_repeated, "a1_lowest_grades": lowest_grades, "a8_merged_grades": merged_grades, "w1_w3_filled": filled_levels, "w7_progress": progress,
    "j8_a6_coverage": coverage_exact, "j9_contained": coverage_contained, "a7_run_results": run_results, "a12_manifest": manifest, "j10_first_seen": first_seen, "sk11_write_back": write_back, "e21_domain_groups": domain_groups,
    "o7_set_operations": set_operations, "st5_hash_changes": hash_changes, "j1_fuzzy_match": fuzzy_match, "x1_to_x3_ratios": ratios, "j5_grade_match": grade_match, "a4_evidence": evidence,
    "a5_arbitration": arbitration, "j6_faculty_uids": faculty_uids, "j7_faculty_names": faculty_names, "e13_from_papers": from_papers, "e8_narratives": narratives, "e1_flat_export": flat_export, "e3_e4_careers": careers, "e7_retrieval": retrieval, "e5_e10_requirements": requirements, "sk5_upsert": upserted,
    "st2_breaker_table": breaker_table, "st1_breaker_stream": breaker_stream,
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {_q(w)})" for w in words) + ")"


def _alt(words) -> str:
    return "|".join(words)


def name_sql(source: str, name: str = "name", keep: str = "uid") -> str:
    """F1 as a query: the kept columns, status, score and reason."""
    norm = f"regexp_replace(translate(lower(regexp_replace({name}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')), {DIA}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    bad = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches(n, '(^|\\s){k}') THEN {_q(k)} END" for k in NEGATIVE) + ")"
    title = SQL_IS_TITLE.replace("name,", f"{name},")
    points = (
        f"20 + CASE WHEN regexp_matches(n, '(^|\\s)({_alt(POSITIVE)})') THEN 20 ELSE 0 END + CASE WHEN regexp_matches(n, '({_alt(SUFFIXES)})(\\s|$)') THEN 15 ELSE 0 END"
        f" + CASE WHEN len(list_filter(regexp_split_to_array(n, '[\\s\\p{{Z}}]+'), lambda x: x <> '')) >= 2 THEN 10 ELSE 0 END + CASE WHEN {title} THEN 10 ELSE 0 END"
    )
    return f"""(SELECT {keep}, split_part(r, '#', 1) AS status, split_part(r, '#', 2)::INT AS score, split_part(r, '#', 3) AS reason FROM (SELECT *, CASE
WHEN {name} IS NULL OR {name} = '' THEN 'FAIL#0#Empty string' WHEN length({name}) < 4 THEN 'FAIL#0#Too short' WHEN length({name}) > 150 THEN 'FAIL#0#Too long'
WHEN length(regexp_replace(n, '[^0-9]', '', 'g')) / length({name}) > 0.4 THEN 'FAIL#10#High digit ratio (looks like phone/CNP)'
WHEN length(l) >= 6 AND len(list_distinct(list_filter(string_split(l, ''), lambda x: x <> ''))) <= 2 THEN 'FAIL#5#Low character diversity'
WHEN {bad} IS NOT NULL THEN 'FAIL#0#Negative keyword: ' || {bad}
WHEN pts >= 45 THEN 'PASS#' || pts || '#Good score' WHEN pts >= 30 THEN 'QUARANTINE#' || pts || '#Low confidence' ELSE 'FAIL#' || pts || '#Low score' END AS r
FROM (SELECT *, {points} AS pts, regexp_replace(n, '[^\\p{{L}}]', '', 'g') AS l FROM (SELECT *, {norm} AS n FROM {source}))))"""


def _score_sql(target: str) -> str:
    text, link = "lower(coalesce(link_text, ''))", "lower(coalesce(coalesce(pdf_url, url), ''))"
    against = [w for t in AGAINST[target] for w in DOCUMENT_TYPES[t]]
    return (
        f"(CASE WHEN contains({text}, '{YEAR}') OR contains({link}, '{YEAR}') THEN 10.0 WHEN contains({text}, '{YEAR - 1}') OR contains({link}, '{YEAR - 1}') THEN {8.0 if target == 'RESULTS' else 5.0} ELSE 0.0 END"
        f" + CASE WHEN {_any(text, DOCUMENT_TYPES[target])} OR {_any(link, DOCUMENT_TYPES[target])} THEN 15.0 ELSE 0.0 END - CASE WHEN {_any(text, against)} THEN 10.0 ELSE 0.0 END - CASE WHEN {_any(text, DOCUMENT_TYPES['CALENDAR'])} THEN 20.0 ELSE 0.0 END)::DOUBLE"
    )


def _ranked_sql(target: str) -> str:
    return f"""SELECT input_pos, faculty_slug, stage_a_score, row_number() OVER (PARTITION BY faculty_slug ORDER BY stage_a_score DESC, input_pos, address)::INT AS place
FROM (SELECT DISTINCT ON (input_pos) input_pos, faculty_slug, coalesce(pdf_url, url) AS address, link_text, {_score_sql(target)} AS stage_a_score FROM pdf_queue) WHERE coalesce(link_text, '') <> '' AND coalesce(address, '') <> ''"""


_LINES = "(SELECT source AS g, doc_id AS p, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS line, pos FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL) WHERE regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> '')"
_REPEATED = f"(SELECT g, line, pages, all_pages FROM (SELECT g, line, count(DISTINCT p) AS pages FROM {_LINES} GROUP BY g, line) JOIN (SELECT g, count(DISTINCT p) AS all_pages FROM {_LINES} GROUP BY g) USING (g) WHERE all_pages > 1 AND pages / all_pages > 0.02)"
_GRADE = "CASE WHEN NOT isnan(last_admission_grade) THEN last_admission_grade END"
_OWNERS = "(SELECT DISTINCT coalesce(pdf_url, url) AS pdf_url, lower(faculty_slug) AS faculty_slug FROM pdf_queue WHERE coalesce(pdf_url, url) IS NOT NULL)"
_PAIRED = f"(SELECT r.*, o.faculty_slug FROM (SELECT DISTINCT * FROM pdf_rows) r JOIN {_OWNERS} o ON r.pdf_url = o.pdf_url)"
_SIDES = f"""p AS (SELECT DISTINCT uid AS pid, lower(faculty_slug) AS faculty_slug, {sql_comparable('name')} AS a, lower(coalesce(level, '')) AS la, lower(coalesce(domain, '')) AS da FROM programs),
r AS (SELECT DISTINCT pdf_url || '#' || row_idx AS rid, faculty_slug, {sql_comparable('program_name')} AS b, lower(coalesce(level, '')) AS lb, lower(coalesce(domain, '')) AS db FROM {_PAIRED})"""
_PAIRS = """pairs AS MATERIALIZED (SELECT p.faculty_slug, pid, rid, a, b, la, lb, da, db FROM p JOIN r ON p.faculty_slug = r.faculty_slug
WHERE NOT (lb <> '' AND (((contains(la, 'licenta') OR contains(la, 'licență')) AND contains(lb, 'master')) OR (contains(la, 'master') AND (contains(lb, 'licenta') OR contains(lb, 'licență'))))))"""
_SCORED = f"""names AS (SELECT * FROM {sql_ratios('pairs')}), domains AS (SELECT * FROM {sql_ratios("(SELECT da AS a, db AS b FROM pairs WHERE da <> '' AND db <> '')")}),
scored AS (SELECT faculty_slug, pid, rid, CASE WHEN ns < 0.3 THEN 0.0 ELSE least(0.5 * ns + 0.3 * ls + 0.2 * ds, 1.0) END AS score FROM (SELECT q.*, greatest(n.token_set, n."partial") / 100.0 AS ns,
CASE WHEN la <> '' AND lb <> '' THEN CASE WHEN contains(la, lb) OR contains(lb, la) THEN 1.0 ELSE 0.0 END WHEN la = '' AND lb = '' THEN 0.5 ELSE 0.0 END AS ls, CASE WHEN d."partial" > 80 THEN 1.0 ELSE 0.0 END AS ds
FROM pairs q JOIN names n ON q.a = n.a AND q.b = n.b LEFT JOIN domains d ON q.da = d.a AND q.db = d.b))"""
_MATCHES = f"""(SELECT DISTINCT ON (p.uid, p.faculty_slug, r.pdf_url, r.row_idx) p.uid, r.*, 1.0 - pdf_rank / 100.0 AS match_score FROM (SELECT DISTINCT uid, name, lower(faculty_slug) AS faculty_slug, {sql_comparable('name')} AS form FROM programs) p
JOIN (SELECT DISTINCT ON (pdf_url, row_idx, faculty_slug) *, {sql_comparable('program_name')} AS form FROM {_PAIRED}) r ON p.faculty_slug = r.faculty_slug AND p.form = r.form)"""
_LIKELY = "round(0.6 * {m} + 0.4 * CASE WHEN content_score > 10 THEN 0.9 WHEN content_score > 0 THEN 0.7 ELSE 0.5 END, 4)"


def _career_sql(c: str) -> tuple[str, str]:
    first = "CASE " + " ".join(f"WHEN contains(lower({c}), {_q(k)}) THEN {_q(','.join(v))}" for k, v in CAREERS_FIRST.items()) + f" ELSE {_q(NO_CAREER[0])} END"
    each = ", ".join(f"CASE WHEN contains(lower({c}), {_q(k)}) THEN [{', '.join(map(_q, v))}] ELSE []::VARCHAR[] END" for k, v in CAREERS_ALL.items())
    every = f"list_sort(list_distinct(flatten([{each}])))"
    return first, f"CASE WHEN len({every}) > 0 THEN array_to_string({every}, ',') ELSE {_q(NO_CAREER[0])} END"


_FIRST, _ALL = _career_sql("name")
_WORD_LIST = """list_sort(list_distinct(list_transform(list_filter(list_concat([name, faculty_slug], regexp_split_to_array(lower(name), '\\s+'), CASE WHEN contains(lower(name), 'calc') THEN ['computer science', 'it', 'programare'] ELSE []::VARCHAR[] END,
CASE WHEN contains(lower(name), 'auto') THEN ['control engineering', 'robotics'] ELSE []::VARCHAR[] END, CASE WHEN contains(lower(name), 'englez') OR contains(lower(name), 'english') THEN ['international'] ELSE []::VARCHAR[] END), lambda w: w IS NOT NULL AND length(w) > 2), lambda w: lower(w))))"""
_LANGUAGE = "CASE WHEN contains(lower(name), 'englez') OR contains(lower(name), 'english') THEN 'en' WHEN contains(lower(name), 'francez') THEN 'fr' ELSE 'ro' END"
_REQUIRED = "CASE WHEN contains(lower(coalesce(level, '')), 'master') THEN 'Media Licență (Probabil Interviu)' ELSE 'Dosar (Medie Bac)' END"
_SAID = "coalesce({}::VARCHAR, 'None')"
_LOW = "lower(spots_raw)"
_HAS = f"(regexp_matches(spots_raw, '{BUDGET_PATTERN}') OR regexp_matches(spots_raw, '{TAX_PATTERN}'))"

SQL = {
    "f1_name_validation": f"SELECT * FROM {name_sql('(SELECT DISTINCT uid, name FROM programs)')}",
    "f2_to_f5_row_validation": f"""SELECT DISTINCT uid, hygiene, identifiers, spots, CASE WHEN f.status = 'FAIL' THEN 'FAIL' WHEN hygiene = 'Missing name' THEN 'FAIL' WHEN identifiers <> 'Identifiers present' THEN 'REVIEW' WHEN spots = 'REJECT' THEN 'REJECT' ELSE 'PASS' END AS status,
CASE WHEN f.status = 'FAIL' THEN f.reason WHEN hygiene = 'Missing name' THEN hygiene WHEN identifiers <> 'Identifiers present' THEN identifiers WHEN spots = 'REJECT' THEN 'Spots unverified by high-quality evidence' ELSE 'All checks passed' END AS reason FROM (
SELECT uid, name, CASE WHEN name IS NULL OR name = '' THEN 'Missing name' WHEN regexp_matches(name, '{NOISE_PATTERN}') THEN 'Name contains UI noise' WHEN regexp_matches(name, '{COUNT_PATTERN}') THEN 'Name contains embedded counts' ELSE 'Clean name' END AS hygiene,
CASE WHEN coalesce(program_id, '') = '' THEN 'Missing program_id' WHEN coalesce(admission_year, 0) = 0 THEN 'Missing admission_year' ELSE 'Identifiers present' END AS identifiers,
CASE WHEN spots_budget IS NULL AND spots_tax IS NULL THEN 'PASS' WHEN len(list_filter(evidence['spots'], lambda e: coalesce(e.match_score, 0) >= 0.75 AND coalesce(e.score, 0) >= 20 AND ((spots_budget IS NOT NULL AND e.value.budget IS NOT NULL) OR (spots_tax IS NOT NULL AND e.value.tax IS NOT NULL)))) > 0 THEN 'PASS'
WHEN source_type = 'html_table_parsed' AND NOT isnan(accuracy_confidence) AND accuracy_confidence >= 0.8 THEN 'PASS' ELSE 'REJECT' END AS spots FROM programs) JOIN (SELECT DISTINCT * FROM {name_sql('(SELECT DISTINCT name FROM programs)', keep='name')}) f USING (name)""",
    "f1_quarantine_split": f"SELECT pdf_url, row_idx, program_name, status, reason FROM {name_sql('(SELECT DISTINCT * FROM pdf_rows)', 'program_name', 'pdf_url, row_idx, program_name')}",
    "sk6_quarantine": f"SELECT sha256(program_name) AS key, program_name AS name, reason, score FROM {name_sql('(SELECT DISTINCT program_name FROM pdf_rows)', 'program_name', 'program_name')} WHERE status = 'QUARANTINE'",
    "f7_list_items": f"SELECT spots_raw, (({_HAS} AND NOT {_any(_LOW, LIST_NOISE_MORE)}) OR (NOT {_HAS} AND {_any(_LOW, LIST_WHITELIST)} AND NOT {_any(_LOW, LIST_NOISE_MORE)} AND length(spots_raw) >= 10)) AND NOT regexp_matches(spots_raw, '(?i)^(tel|fax|str|bd|nr)\\.?\\s*:') AS accepted FROM (SELECT DISTINCT spots_raw FROM programs WHERE spots_raw IS NOT NULL)",
    "e2_f10_published": f"""SELECT DISTINCT {SQL_DISPLAY} AS program_name, split_part(regexp_extract(url, 'https?://([^/]+)', 1), '.', 1) AS faculty_code, level, b AS budget, t AS tax, CASE WHEN c > 0.8 THEN 'high' ELSE 'medium' END AS confidence, url
FROM (SELECT name, level, source_url AS url, coalesce(spots_budget, 0) AS b, coalesce(spots_tax, 0) AS t, coalesce(CASE WHEN NOT isnan(accuracy_confidence) THEN accuracy_confidence END, 0.0) AS c FROM programs) WHERE NOT (c < 0.4 AND b = 0)""",
    "e14_ranked_spots": _ranked_sql("SPOTS"),
    "e14_ranked_results": _ranked_sql("RESULTS"),
    "o2_best_papers": f"SELECT * FROM ({_ranked_sql('SPOTS')}) WHERE place <= 3",
    "f13_grade_links": "SELECT * FROM (SELECT DISTINCT ON (input_pos) input_pos, CASE WHEN contains(lower(link_text), 'rezultate') OR contains(lower(link_text), 'admis') OR contains(lower(link_text), 'liste') OR contains(lower(link_text), 'clasament') OR contains(lower(link_text), 'medii') THEN 10 ELSE 0 END - CASE WHEN contains(lower(link_text), 'cazare') OR contains(lower(link_text), 'burse') OR contains(lower(link_text), 'programare') THEN 100 ELSE 0 END + CASE WHEN contains(lower(link_text), '2026') OR contains(coalesce(pdf_url, url, ''), '2026') THEN 5 ELSE 0 END AS score FROM pdf_queue WHERE link_text IS NOT NULL) WHERE score > 0",
    "e15_paper_contents": """SELECT pdf_url, sum(length(t)) / greatest(1, count(*)) AS text_density, bool_or(contains(t, '|')) AS has_table, sum(len(regexp_extract_all(t, '(?i)\\d+\\s+(?:loc|buget|tax)')))::BIGINT AS rows_with_numbers, CASE WHEN bool_or(contains(t, '2026')) THEN 2026 END AS detected_year,
(CASE WHEN sum(length(t)) / greatest(1, count(*)) < 50 THEN -2.0 ELSE 5.0 END + CASE WHEN sum(len(regexp_extract_all(t, '(?i)\\d+\\s+(?:loc|buget|tax)'))) > 0 THEN 10.0 + least(sum(len(regexp_extract_all(t, '(?i)\\d+\\s+(?:loc|buget|tax)'))), 10) ELSE 0.0 END + CASE WHEN bool_or(contains(t, '|')) THEN 5.0 ELSE 0.0 END)::DOUBLE AS content_score
FROM (SELECT concat_ws('/', source, faculty_slug) AS pdf_url, coalesce(text, '') AS t, row_number() OVER (PARTITION BY concat_ws('/', source, faculty_slug) ORDER BY doc_id) AS n FROM documents) WHERE n <= 2 GROUP BY pdf_url""",
    "f15_trusted_papers": "SELECT pdf_url, count(*) AS n_rows, count(*) FILTER (length(program_name) > 5 AND NOT contains(lower(program_name), 'copie')) AS n_valid FROM (SELECT DISTINCT * FROM pdf_rows) GROUP BY pdf_url HAVING n_valid > 0 AND n_valid >= 0.5 * n_rows AND NOT coalesce(max(content_score) < -5, false)",
    "a2_repeated_lines": f"SELECT g AS source, line, pages, all_pages FROM {_REPEATED}",
    "a3_without_repeated": f"SELECT p AS doc_id, md5(string_agg(l.line, chr(10) ORDER BY pos)) AS text_md5 FROM {_LINES} l ANTI JOIN {_REPEATED} r ON l.g = r.g AND l.line = r.line GROUP BY l.g, p",
    "a1_lowest_grades": f"SELECT faculty_slug, count(*) AS n_grades, min(g) FILTER (g BETWEEN 5 AND 10) AS min_grade FROM (SELECT DISTINCT uid, lower(faculty_slug) AS faculty_slug, {_GRADE} AS g FROM programs) WHERE g BETWEEN 1 AND 10 GROUP BY faculty_slug HAVING count(*) >= 3 AND min_grade IS NOT NULL",
    "a8_merged_grades": f"SELECT faculty_slug, arg_max(m, run_id) AS min_grade FROM (SELECT faculty_slug, run_id, min(g) FILTER (g BETWEEN 5 AND 10) AS m FROM (SELECT DISTINCT uid, run_id, lower(faculty_slug) AS faculty_slug, {_GRADE} AS g FROM programs) WHERE g BETWEEN 1 AND 10 GROUP BY ALL HAVING count(*) >= 3 AND m IS NOT NULL) GROUP BY faculty_slug",
    "w1_w3_filled": "SELECT pdf_url, row_idx, last_value(page IGNORE NULLS) OVER w AS page, first_value(page IGNORE NULLS) OVER w AS first_page FROM (SELECT DISTINCT ON (pdf_url, row_idx) * FROM pdf_rows) WINDOW w AS (PARTITION BY pdf_url ORDER BY row_idx ROWS UNBOUNDED PRECEDING)",
    "w7_progress": "SELECT slug, '[' || row_number() OVER (ORDER BY pos) || '/' || count(*) OVER () || ']' AS progress FROM faculties",
    "j8_a6_coverage": "SELECT level, count(*) AS total, count(*) FILTER (found) AS found, round(100.0 * count(*) FILTER (found) / count(*), 4)::DOUBLE AS percentage FROM (SELECT level, coalesce(trim(replace(translate(lower(name), 'ăâșțî', 'aasti'), '-', ' ')) IN (SELECT trim(replace(translate(lower(name), 'ăâșțî', 'aasti'), '-', ' ')) FROM program_catalog WHERE name IS NOT NULL), false) AS found FROM firecrawl) GROUP BY ROLLUP (level)",
    "j9_contained": "SELECT key FROM (SELECT firecrawl_id AS key, trim(replace(translate(lower(name), 'ăâșțî', 'aasti'), '-', ' '), ' ') AS f FROM firecrawl) t WHERE f <> '' AND EXISTS (SELECT 1 FROM (SELECT DISTINCT trim(replace(translate(lower(name), 'ăâșțî', 'aasti'), '-', ' '), ' ') AS g FROM programs) o WHERE g <> '' AND (contains(f, g) OR contains(g, f)))",
    "a7_run_results": "SELECT count(*) AS urls, count(*) FILTER (status = 'done') AS success, count(*) - count(*) FILTER (status = 'done') AS failed FROM pdf_queue",
    "a12_manifest": "SELECT 'run' AS run_id, count(*) AS faculties_total, string_agg(s, ',' ORDER BY s) FILTER (ok) AS successful FROM (SELECT lower(faculty_slug) AS s, bool_or(coalesce(status = 'done', false)) AS ok FROM pdf_queue GROUP BY 1)",
    "j10_first_seen": "SELECT min(input_pos) AS input_pos, coalesce(pdf_url, url) AS address FROM pdf_queue WHERE coalesce(pdf_url, url) IS NOT NULL GROUP BY 2",
    "sk11_write_back": "WITH q AS (SELECT DISTINCT ON (input_pos) *, coalesce(pdf_url, url) AS address FROM pdf_queue), w AS (SELECT DISTINCT address FROM q WHERE status IN ('queued', 'pending') AND address IS NOT NULL) SELECT input_pos, CASE WHEN w.address IS NOT NULL THEN 'downloaded' ELSE status END AS status, CASE WHEN w.address IS NOT NULL THEN 'spots_' || left(md5(w.address), 8) || '.pdf' ELSE local_path END AS local_path FROM q LEFT JOIN w ON q.address = w.address",
    "e21_domain_groups": "SELECT DISTINCT input_pos, a AS address, CASE WHEN contains(a, 'corveni.example') OR contains(a, 'central.example') THEN 'main' WHEN contains(a, 'example') THEN 'all' ELSE 'default' END AS longest, CASE WHEN contains(a, 'example') THEN 'all' ELSE 'default' END AS first FROM (SELECT input_pos, coalesce(pdf_url, url) AS a FROM pdf_queue) WHERE a IS NOT NULL",
    "o7_set_operations": "WITH a AS (SELECT DISTINCT lower(faculty_slug) AS s FROM programs), b AS (SELECT DISTINCT lower(faculty_slug) AS s FROM pdf_queue) SELECT 'both' AS kind, s FROM (SELECT s FROM a INTERSECT SELECT s FROM b) UNION ALL SELECT 'only', s FROM (SELECT s FROM a EXCEPT SELECT s FROM b) UNION ALL SELECT 'either', s FROM (SELECT s FROM a UNION SELECT s FROM b)",
    "st5_hash_changes": "SELECT coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NULL THEN 'new' WHEN n.key IS NULL THEN 'removed' WHEN o.t <> n.t THEN 'changed' ELSE 'same' END AS kind FROM (SELECT doc_id AS key, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents WHERE admission_year IS NULL OR admission_year <> 2025) o FULL JOIN (SELECT doc_id AS key, trim(CASE WHEN text LIKE '%.' THEN text || '!' ELSE coalesce(text, '') END, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents WHERE admission_year IS NULL OR admission_year >= 2025) n ON o.key = n.key",
    "j1_fuzzy_match": f"""WITH {_SIDES}, {_PAIRS}, {_SCORED}, s AS (SELECT *, row_number() OVER (PARTITION BY faculty_slug, pid ORDER BY score DESC, rid) AS place FROM scored WHERE score > 0.01), t AS (SELECT faculty_slug, pid, max(rid) FILTER (place = 1) AS rid, max(score) FILTER (place = 1) AS score, max(score) FILTER (place = 2) AS second FROM s WHERE place <= 2 GROUP BY ALL)
SELECT p.pid, rid, round(coalesce(score, 0), 6)::DOUBLE AS score, CASE WHEN score IS NULL THEN 'no_match' WHEN score < 0.5 THEN 'low_confidence' WHEN round(score - second, 9) < 0.15 THEN 'ambiguous' ELSE 'match' END AS status, coalesce(score > 0.65, false) AS accepted FROM (SELECT DISTINCT pid, faculty_slug FROM p) p LEFT JOIN t ON p.pid = t.pid AND p.faculty_slug = t.faculty_slug""",
    "j5_grade_match": f"""WITH p AS (SELECT DISTINCT uid AS pid, lower(faculty_slug) AS faculty_slug, {sql_match_form('name')} AS a FROM programs),
g AS (SELECT faculty_slug, program_name AS grade_key, {sql_match_form('program_name')} AS b, (5.0 + least(coalesce(min(spots_budget), 0), 50) / 10.0)::DOUBLE AS min_grade, min(pdf_url || '#' || row_idx) AS key_pos FROM {_PAIRED} WHERE program_name IS NOT NULL GROUP BY 1, 2, 3),
pairs AS MATERIALIZED (SELECT * FROM p JOIN g USING (faculty_slug))
SELECT faculty_slug, pid, grade_key, min_grade, round(token_set, 6) AS alike FROM pairs JOIN {sql_ratios('pairs')} n ON pairs.a = n.a AND pairs.b = n.b WHERE token_set > 85 QUALIFY row_number() OVER (PARTITION BY faculty_slug, pid ORDER BY token_set DESC, key_pos) = 1""",
    "x1_to_x3_ratios": f"""WITH p AS (SELECT DISTINCT uid, {sql_comparable('name')} AS a, {sql_comparable('spots_raw')} AS b FROM programs) SELECT DISTINCT uid, round(token_set, 6) AS token_set, round("partial", 6) AS "partial", round(indel, 6) AS indel FROM p JOIN {sql_ratios('p')} n ON p.a = n.a AND p.b = n.b""",
    "a4_evidence": f"SELECT uid, count(*) AS n_items, string_agg(concat_ws('/', pdf_url, spots_budget, spots_tax, coalesce(page, 1), left(coalesce(raw_row, ''), 100)), '|' ORDER BY pdf_rank NULLS FIRST, row_idx NULLS FIRST, pdf_url) AS items FROM {_MATCHES} GROUP BY uid",
    "a5_arbitration": f"SELECT uid, pdf_url, row_idx, spots_budget, spots_tax, round(coalesce(content_score, 0) + 10 * match_score, 6) AS best_source_score, {_LIKELY.format(m='match_score')} AS accuracy_confidence FROM {_MATCHES} QUALIFY row_number() OVER (PARTITION BY uid ORDER BY coalesce(content_score, 0) + 10 * match_score DESC, pdf_rank NULLS LAST, row_idx NULLS LAST, pdf_url DESC) = 1",
    "j6_faculty_uids": "SELECT DISTINCT p.uid AS program_uid, CASE WHEN f.slug IS NOT NULL THEN sha256('listed:' || f.slug) ELSE sha256('faculty:' || p.faculty_slug) END AS resolved_faculty_uid FROM programs p LEFT JOIN faculties f ON p.faculty_slug = f.slug",
    "j7_faculty_names": "SELECT DISTINCT p.uid AS program_uid, coalesce(f.name, upper(p.faculty_slug)) AS faculty_name FROM programs p LEFT JOIN (SELECT slug, max(name) AS name FROM faculties GROUP BY slug) f ON p.faculty_slug = f.slug",
    "e13_from_papers": f"""SELECT sha256(faculty_slug || '|' || program_name) AS uid, sha256(faculty_slug || '|' || {sql_match_form('program_name')}) AS program_id, faculty_slug, program_name AS name, CASE WHEN level IS NULL THEN 'Unknown' WHEN contains(lower(level), 'master') THEN 'Master' WHEN contains(lower(level), 'licent') OR contains(lower(level), 'bachelor') THEN 'Bachelor' WHEN contains(lower(level), 'doctor') OR contains(lower(level), 'phd') THEN 'PhD' ELSE 'Unknown' END AS level,
spots_budget, spots_tax, pdf_url AS source_url, 'pdf_only' AS source_type, 0.92::DOUBLE AS likelihood_score FROM (SELECT * FROM {_PAIRED} WHERE faculty_slug NOT IN (SELECT lower(faculty_slug) FROM programs WHERE faculty_slug IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY faculty_slug, program_name ORDER BY pdf_rank DESC NULLS LAST, row_idx DESC NULLS LAST, pdf_url DESC) = 1)""",
    "e8_narratives": f"SELECT DISTINCT uid, md5('Programul: ' || name || ' (' || coalesce(level, 'Master') || ')' || chr(10) || 'Facultate: ' || upper(faculty_slug) || chr(10) || 'Locuri Buget: ' || {_SAID.format('spots_budget')} || ' (Sursa: PDF ' || source_url || ')' || chr(10) || 'Locuri Taxa: ' || {_SAID.format('spots_tax')} || ' (Sursa: PDF ' || source_url || ')' || chr(10) || '[INFERENCE]' || chr(10) || 'Cariera: ' || replace({_FIRST}, ',', ', ')) AS text_md5, CASE WHEN {_GRADE} IS NULL THEN 'x' ELSE 'x' || chr(10) || 'Ultima Medie (2025): ' || printf('%.2f', {_GRADE}) END AS grade_line FROM programs",
    "e1_flat_export": f"SELECT name, level, faculty_slug, duration_years, spots_budget, spots_tax, coalesce(source_type, 'unknown') AS source_type, coalesce(CASE WHEN NOT isnan(accuracy_confidence) THEN accuracy_confidence END, 0.0) AS accuracy_confidence, source_url AS url, {_GRADE} AS last_admission_grade FROM programs",
    "e3_e4_careers": f"SELECT DISTINCT uid, {_FIRST} AS first_careers, {_ALL} AS all_careers FROM programs",
    "e7_retrieval": f"""SELECT uid, program_id, language, array_to_string(kw, ',') AS keywords, career_paths, '[FACTS]' || chr(10) || concat_ws(chr(10), 'Program: ' || name, 'Nivel: ' || coalesce(level, 'Licenta'), 'Facultate: ' || upper(faculty_slug), 'Durata: ' || coalesce(duration_years, 'N/A'), 'Limba: ' || upper(language),
'Locuri Buget ({YEAR}): ' || coalesce(spots_budget::VARCHAR, 'N/A'), 'Locuri Taxa ({YEAR}): ' || coalesce(spots_tax::VARCHAR, 'N/A')) || chr(10) || chr(10) || '[INFERRED]' || chr(10) || concat_ws(chr(10), 'Cariera: ' || replace(career_paths, ',', ', '),
'Admitere: ' || {_REQUIRED}, 'Keywords: ' || array_to_string(kw, ', ')) || chr(10) || chr(10) || '[PROVENANCE]' || chr(10) || 'Source: ' || coalesce(source_url, 'N/A') AS text_for_embedding
FROM (SELECT DISTINCT uid, '{PREFIX}_' || concat_ws('_', faculty_slug, left(uid, 8)) AS program_id, {_LANGUAGE} AS language, {_WORD_LIST} AS kw, coalesce({_ALL}, '{NO_CAREER[0]}') AS career_paths, name, level, faculty_slug, duration_years, spots_budget, spots_tax, source_url FROM programs)""",
    "e5_e10_requirements": f"SELECT DISTINCT uid, level, {_REQUIRED} AS requirements, CASE WHEN source_type = 'html_table_parsed' THEN 0.85 WHEN source_type = 'jsonld' THEN 0.6 WHEN coalesce(spots_budget, 0) <> 0 THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence FROM programs",
    "sk5_upsert": "WITH p AS (SELECT DISTINCT uid, run_id, scraped_at AS seq FROM programs), s AS (SELECT lower(trim(uid)) AS uid, run_id, scraped_at AS seq FROM program_snapshots) SELECT * FROM p UNION ALL SELECT uid, arg_max(run_id, seq), max(seq) FROM s WHERE uid NOT IN (SELECT uid FROM p) GROUP BY uid",
    "st1_breaker_stream": """WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS key, ts AS tm, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type <> 'error') AS n FROM events),
s AS (SELECT key, tm, n, CASE WHEN ok THEN 0 ELSE 1 END AS failures, CASE WHEN NOT ok THEN tm END AS last FROM e WHERE n = 1
UNION ALL SELECT e.key, e.tm, e.n, CASE WHEN e.ok THEN 0 WHEN s.failures >= 3 AND e.tm > s.last + INTERVAL 300 SECOND THEN 1 ELSE s.failures + 1 END, CASE WHEN e.ok THEN s.last ELSE e.tm END FROM s JOIN e ON e.key = s.key AND e.n = s.n + 1)
SELECT key, tm AS "at", failures, failures >= 3 AS open FROM s""",
    "st2_breaker_table": "SELECT event_id, f::BIGINT AS failures, f >= 3 AS open FROM (SELECT event_id, sum(bad) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS f FROM (SELECT *, (event_type = 'error')::INT AS bad, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events))",
}
