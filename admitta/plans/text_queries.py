"""Queries on text, identity and parsing functions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.functions import identity, parse, text
from admitta.functions.vocab import ABBREVIATIONS, BOTH_PATTERN, BUDGET_PATTERN, COUNT_PATTERN, TAX_PATTERN
from admitta.sources.tables import table

DIA = "'ăâîșşțţ', 'aaisstt'"


def sql_match_form(c: str) -> str:
    return f"coalesce(trim(regexp_replace(regexp_replace(translate(lower({c}), {DIA}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g')), '')"


def sql_comparable(c: str) -> str:
    out = sql_match_form(c)
    for short, long in ABBREVIATIONS.items():
        out = f"regexp_replace({out}, '(?i)\\b{short}\\b', '{long}', 'g')"
    return out


def sql_slug(c: str) -> str:
    src, dst = text.LATIN
    bare = f"regexp_replace(regexp_replace(lower({c}), '\\(.*?\\)', '', 'g'), '\\d{{4}}', '', 'g')"
    return f"trim(regexp_replace(regexp_replace(translate({bare}, '{src}', '{dst}'), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-')"


SQL_IS_TITLE = "(regexp_matches(name, '\\p{Lu}') AND NOT regexp_matches(name, '(^|[^\\p{Lu}\\p{Ll}])\\p{Ll}') AND NOT regexp_matches(name, '[\\p{Lu}\\p{Ll}]\\p{Lu}'))"
SQL_DISPLAY = (
    "(CASE WHEN coalesce(name, '') = '' THEN 'Unknown' ELSE list_transform([trim(regexp_replace(regexp_replace(regexp_replace(name, '(?i)\\(?(?:aici|detalii|vezi|link)\\)?', '', 'g'), '\\[.*?\\]', '', 'g'), '[\\s\\p{Z}]+', ' ', 'g'), ' ')],"
    " lambda f: replace(CASE WHEN upper(f) = f AND regexp_matches(f, '\\p{L}') THEN array_to_string(list_transform(regexp_extract_all(f, '[\\p{L}\\p{M}]+|[^\\p{L}\\p{M}]+'), lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), '') ELSE f END, ' ,', ','))[1] END)"
)
NAMES = "(SELECT DISTINCT uid, name FROM programs)"


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "programs").select("uid", "name").dropDuplicates()


def _queue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pdf_queue").select("input_pos", F.coalesce("pdf_url", "url").alias("address"), "source_url", "link_text").dropDuplicates()


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pdf_rows").select("pdf_url", "row_idx", "program_name").dropDuplicates()


def _on_names(**cols):
    return lambda spark, folder: _names(spark, folder).select("uid", *(c.alias(n) for n, c in ((n, f()) for n, f in cols.items())))


#: An address as a page might link it: upper-case host, port, tracking and blank keys, fragment.
_DIRTY = "concat(upper(substr(address, 1, 12)), substr(address, 13), '?utm_source=x&b=2&a=1&blank=&ref=r', '#top')"


def canonical(spark: SparkSession, folder: str) -> DataFrame:
    urls = _queue(spark, folder).select("address").dropDuplicates().withColumn("dirty", F.expr(_DIRTY))
    return urls.select("address", identity.canonical_url(F.col("dirty")).alias("canonical"), identity.host(F.col("address")).alias("host"), identity.subdomain(F.col("address")).alias("faculty_code"))


def page_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "documents").select("doc_id", F.concat(F.col("url"), F.lit("?utm_source=mail&page=1#x")).alias("u"))
    keyed = urls.withColumn("canonical_uid", identity.uid(identity.canonical_url(F.col("u"))))
    return keyed.where("canonical_uid IS NOT NULL").groupBy("canonical_uid").agg(F.max("doc_id").alias("last_doc_id"), F.count(F.lit(1)).alias("n_docs"))


def host_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.groupBy(identity.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("chars"))


def content_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", identity.content_hash(F.col("text")).alias("content_hash"))
    return docs.groupBy("content_hash").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("copies"))


def numbers(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs").select("uid", "spots_raw", "spots_budget", "last_admission_grade").dropDuplicates()
    noted = F.concat(F.col("spots_budget").cast("string"), F.lit(" (2 rromi)"))
    decimals = F.concat(F.col("spots_budget").cast("string"), F.lit(".7"))
    comma = F.replace(F.round(F.nanvl("last_admission_grade", F.lit(None).cast("double")), 2).cast("string"), F.lit("."), F.lit(","))
    return p.select("uid", "spots_raw", parse.count_of(noted).alias("noted"), parse.count_or_zero(decimals).alias("whole"), parse.grade(comma).alias("grade")).select("uid", "noted", "whole", "grade").dropDuplicates()


def item_counts(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs").select("uid", "spots_raw").where("spots_raw IS NOT NULL").dropDuplicates()
    return p.withColumn("s", parse.list_spots(F.col("spots_raw"))).select("uid", "spots_raw", F.col("s.budget").alias("budget"), F.col("s.tax").alias("tax"), parse.item_name(F.col("spots_raw")).alias("item_name"))


def link_targets(spark: SparkSession, folder: str) -> DataFrame:
    q = _queue(spark, folder).where("address IS NOT NULL AND source_url IS NOT NULL")
    path = F.regexp_extract("address", r"^[a-z]+://[^/]*(/.*)$", 1)
    last = F.regexp_extract("address", r"([^/]*)$", 1)
    return q.select(
        "input_pos", "address", identity.resolve_link(F.col("source_url"), path).alias("rooted"), identity.resolve_link(F.col("source_url"), last).alias("relative"),
        identity.resolve_link(F.col("source_url"), F.regexp_replace("address", "^https?:", "")).alias("schemeless"), identity.resolve_link(F.col("source_url"), F.col("address")).alias("absolute"),
    ).dropDuplicates()


def levels(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs")
    return p.select("uid", "level", parse.study_level(F.col("level")).alias("study_level"), parse.url_level(F.col("source_url")).alias("url_level"), parse.url_duration(F.col("source_url")).alias("url_duration")).dropDuplicates()


def page_levels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", parse.page_level(F.col("text")).alias("page_level"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder).select("uid", parse.name_language(F.col("name")).alias("language"), parse.name_language(F.col("name"), True).alias("code")).dropDuplicates()


def years(spark: SparkSession, folder: str) -> DataFrame:
    q = _queue(spark, folder)
    return q.select("input_pos", "address", identity.admission_year(F.col("address"), F.col("link_text"), 2026).alias("year"), identity.pdf_name(F.col("address"), "spots").alias("file_name")).dropDuplicates()


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    r = _rows(spark, folder)
    name = F.col("program_name")
    return r.select("pdf_url", "row_idx", parse.without_counts(name).alias("without_counts"), text.unbroken(name).alias("unbroken"), text.snippet(name, 20).alias("snippet"), parse.domain_label(F.concat(F.lit("Domeniul: "), name)).alias("label"))


def markup(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").where("text IS NOT NULL")
    return d.select("doc_id", F.md5(text.markup_text(F.col("text"))).alias("text_md5"), F.size(text.tokens(text.markup_text(F.col("text")))).cast("long").alias("n_tokens"))


def encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Every name as wrongly read, repaired where the rule applies and else unchanged."""
    wrong = F.decode(F.encode(F.col("name"), "UTF-8"), "ISO-8859-1")
    return _names(spark, folder).select("uid", text.repair_encoding(F.col("name")).alias("as_stored"), text.repair_encoding(wrong).alias("repaired"))


QUERIES = {
    "n1_match_form": _on_names(form=lambda: text.match_form(F.col("name"))),
    "n2_rule_form": _on_names(form=lambda: text.rule_form(F.col("name"))),
    "n3_composed": _on_names(form=lambda: text.composed(F.col("name"))),
    "n3_composed_nfc": _on_names(form=lambda: text.composed_nfc(F.col("name"))),
    "n4_slug": _on_names(slug=lambda: text.slug(F.col("name"))),
    "n5_abbreviations": _on_names(form=lambda: text.expand_abbreviations(text.match_form(F.col("name")))),
    "n6_canonical_url": canonical,
    "n7_program_ids": lambda spark, folder: table(spark, folder, "programs").select("uid", identity.program_uid(F.col("source_url"), F.col("name")).alias("html_uid"), identity.program_id(F.col("faculty_slug"), F.col("name")).alias("made_program_id"), identity.faculty_uid(F.col("faculty_slug")).alias("made_faculty_uid"), text.short_id(F.col("uid")).alias("short_id")).dropDuplicates(),
    "n7_page_uid_dedupe": page_dedupe,
    "n8_content_dedupe": content_dedupe,
    "n9_truth_form": _on_names(form=lambda: text.truth_form(F.col("name"))),
    "n10_display_name": _on_names(display_name=lambda: text.display_name(F.col("name"))),
    "n11_title_case": _on_names(title=lambda: text.is_title(F.col("name"))),
    "n12_clean_rows": clean_rows,
    "n13_markup_tokens": markup,
    "p1_to_p3_numbers": numbers,
    "p4_item_counts": item_counts,
    "p9_page_levels": page_levels,
    "p10_years": years,
    "p12_levels": levels,
    "p14_languages": languages,
    "p19_link_targets": link_targets,
    "p20_host_counts": host_counts,
    "sc17_encoding": encoding,
}
# names of problem queries begin with p and a number; these are functions of the pipeline, so they get a prefix of their own
QUERIES = {(f"fn_{k}" if k[0] == "p" else k): f for k, f in QUERIES.items()}

_COMPOSE = "name"
for _apart, _whole in text._compositions():
    _COMPOSE = f"replace({_COMPOSE}, '{_apart}', '{_whole}')"
_TRIM = "regexp_replace({}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
_ADDR = "(SELECT DISTINCT input_pos, coalesce(pdf_url, url) AS address, source_url, link_text FROM pdf_queue)"
_JAVA = COUNT_PATTERN.replace("'", "''")
_PNAME = "(SELECT DISTINCT pdf_url, row_idx, program_name FROM pdf_rows)"
_UNBROKEN = _COMPOSE.replace("(name,", "(program_name,")


def _first(pattern: str, group: int, c: str = "spots_raw") -> str:
    return f"try_cast(nullif(regexp_extract({c}, '{pattern}', {group}), '') AS INT)"


_BOTH = BOTH_PATTERN
_TEXT = "regexp_replace(regexp_replace(text, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g')"
_PLAIN = f"trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({_TEXT}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[\\s\\p{{Z}}]+', ' ', 'g'))"

SQL = {
    "n1_match_form": f"SELECT uid, {sql_match_form('name')} AS form FROM {NAMES}",
    "n2_rule_form": f"SELECT uid, regexp_replace(translate(lower({_TRIM.format('name')}), {DIA}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g') AS form FROM {NAMES}",
    "n3_composed": f"SELECT uid, {_TRIM.format(f'''translate({_COMPOSE}, 'şŞţŢ', 'șȘțȚ')''')} AS form FROM {NAMES}",
    "n3_composed_nfc": f"SELECT uid, {_TRIM.format('''translate(nfc_normalize(name), 'şŞţŢ', 'șȘțȚ')''')} AS form FROM {NAMES}",
    "n4_slug": f"SELECT uid, {sql_slug('name')} AS slug FROM {NAMES}",
    "n5_abbreviations": f"SELECT uid, {sql_comparable('name')} AS form FROM {NAMES}",
    "n6_canonical_url": "SELECT address, address || '?a=1&b=2' AS canonical, regexp_extract(address, '^[a-z]+://([^/]*)', 1) AS host, split_part(regexp_extract(address, '^[a-z]+://([^/]*)', 1), '.', 1) AS faculty_code FROM (SELECT DISTINCT coalesce(pdf_url, url) AS address FROM pdf_queue)",
    "n7_program_ids": f"SELECT DISTINCT uid, sha256(source_url || '|' || {sql_slug('name')}) AS html_uid, sha256(faculty_slug || '|' || {sql_match_form('name')}) AS made_program_id, sha256('faculty:' || faculty_slug) AS made_faculty_uid, left(uid, 8) AS short_id FROM programs",
    "n7_page_uid_dedupe": "SELECT sha256(rtrim(url, '/') || '?page=1') AS canonical_uid, max(doc_id) AS last_doc_id, count(*) AS n_docs FROM documents WHERE url IS NOT NULL GROUP BY 1",
    "n8_content_dedupe": f"SELECT CASE WHEN text IS NULL THEN '' ELSE sha256({_TRIM.format('replace(text, chr(13) || chr(10), chr(10))')}) END AS content_hash, min(doc_id) AS first_doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "n9_truth_form": f"SELECT uid, trim(replace(translate(lower(name), 'ăâșțî', 'aasti'), '-', ' ')) AS form FROM {NAMES}",
    "n10_display_name": f"SELECT uid, {SQL_DISPLAY} AS display_name FROM {NAMES}",
    "n11_title_case": f"SELECT uid, {SQL_IS_TITLE} AS title FROM {NAMES}",
    "n12_clean_rows": f"""SELECT pdf_url, row_idx, CASE WHEN contains(lower(program_name), 'locuri') THEN trim(regexp_replace(program_name, '{_JAVA}', '', 'g'), ' -–—:,.') ELSE program_name END AS without_counts,
replace(replace({_TRIM.format(f"translate({_UNBROKEN}, 'şŞţŢ', 'șȘțȚ')")}, '-' || chr(10), ''), chr(10), ' ') AS unbroken, left(program_name, 20) AS snippet, trim(string_split('Domeniul: ' || program_name, 'Domeniul')[-1], ' :') AS label FROM {_PNAME}""",
    "n13_markup_tokens": f"SELECT doc_id, md5({_PLAIN}) AS text_md5, len(list_filter(regexp_split_to_array({_PLAIN}, '[\\s\\p{{Z}}]+'), lambda x: x <> '')) AS n_tokens FROM documents WHERE text IS NOT NULL",
    "p1_to_p3_numbers": "SELECT DISTINCT uid, try_cast(nullif(regexp_replace(spots_budget::varchar, '\\D', '', 'g'), '') AS INT) AS noted, coalesce(spots_budget, 0) AS whole, CASE WHEN round(last_admission_grade, 2) BETWEEN 1 AND 10 THEN round(last_admission_grade, 2) END AS grade FROM programs",
    "p4_item_counts": f"""SELECT uid, spots_raw, CASE WHEN regexp_matches(spots_raw, '{_BOTH}') THEN {_first(_BOTH, 1)} ELSE {_first(BUDGET_PATTERN, 1)} END AS budget, CASE WHEN regexp_matches(spots_raw, '{_BOTH}') THEN {_first(_BOTH, 2)} ELSE {_first(TAX_PATTERN, 1)} END AS tax,
CASE WHEN contains(head, ';') THEN trim(split_part(head, ';', 1)) ELSE head END AS item_name FROM (SELECT uid, spots_raw, CASE WHEN regexp_matches(split_part(spots_raw, ',', 2), '\\d') OR contains(lower(split_part(spots_raw, ',', 2)), 'locuri') THEN trim(split_part(spots_raw, ',', 1)) ELSE spots_raw END AS head FROM (SELECT DISTINCT uid, spots_raw FROM programs WHERE spots_raw IS NOT NULL))""",
    "p9_page_levels": "SELECT doc_id, CASE WHEN contains(u, 'MASTER') THEN 'Master' WHEN contains(u, 'LICENTA') THEN 'Licenta' END AS page_level FROM (SELECT doc_id, translate(upper(text), 'ĂÂÎȘŞȚŢ', 'AAISSTT') AS u FROM documents)",
    "p10_years": f"SELECT DISTINCT input_pos, address, coalesce(try_cast(nullif(regexp_extract(address, '202[0-9]'), '') AS INT), try_cast(nullif(regexp_extract(link_text, '202[0-9]'), '') AS INT), 2026) AS year, 'spots_' || left(md5(address), 8) || '.pdf' AS file_name FROM {_ADDR}",
    "p12_levels": """SELECT DISTINCT uid, level, CASE WHEN contains(l, 'master') THEN 'Master' WHEN contains(l, 'licent') OR contains(l, 'bachelor') THEN 'Bachelor' WHEN contains(l, 'doctor') OR contains(l, 'phd') THEN 'PhD' ELSE 'Unknown' END AS study_level,
CASE WHEN contains(source_url, 'licenta') THEN 'Licenta' ELSE 'Master' END AS url_level, CASE WHEN contains(source_url, 'licenta') THEN '4 ani' ELSE '2 ani' END AS url_duration FROM (SELECT uid, level, source_url, lower(coalesce(level, '')) AS l FROM programs)""",
    "p14_languages": f"SELECT DISTINCT uid, CASE WHEN contains(l, 'englez') OR contains(l, 'english') THEN 'English' WHEN contains(l, 'francez') THEN 'French' ELSE 'Romanian' END AS language, CASE WHEN contains(l, 'englez') OR contains(l, 'english') THEN 'en' WHEN contains(l, 'francez') THEN 'fr' ELSE 'ro' END AS code FROM (SELECT uid, lower(name) AS l FROM {NAMES})",
    "p19_link_targets": f"""SELECT DISTINCT input_pos, address, regexp_extract(source_url, '^([a-z]+://[^/]*)', 1) || regexp_extract(address, '^[a-z]+://[^/]*(/.*)$', 1) AS rooted, regexp_replace(source_url, '[^/]*$', '') || regexp_extract(address, '([^/]*)$', 1) AS relative, regexp_extract(source_url, '^([a-z]+:)', 1) || regexp_replace(address, '^https?:', '') AS schemeless, address AS absolute
FROM {_ADDR} WHERE address IS NOT NULL AND source_url IS NOT NULL""",
    "p20_host_counts": "SELECT regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host, count(*) AS n_docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1",
    "sc17_encoding": f"""SELECT uid, name AS as_stored, CASE WHEN regexp_matches(name, '[\\x{{100}}-\\x{{13f}}]') THEN name ELSE array_to_string(list_transform(range(0, length(hex(name)) // 2), lambda i: chr(('0x' || substring(hex(name), (2 * i + 1)::BIGINT, 2))::INT)), '') END AS repaired FROM {NAMES}""",
}
SQL = {(f"fn_{k}" if k[0] == "p" else k): s for k, s in SQL.items()}
