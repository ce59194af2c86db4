"""Queries on pages and papers made from the tables, each with SQL that gives the same from the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.functions.vocab import BUDGET_PATTERN, BOTH_PATTERN, LIST_NOISE_MORE, LIST_WHITELIST, NAVIGATION, ROW_BLACKLIST, TAX_PATTERN
from admitta.operators import grades, html, pdf
from admitta.plans.text_queries import DIA, sql_slug
from admitta.sources.tables import table

#: Records on one made page, and table rows on one made page of a paper.
PAGE_RECORDS, PAPER_ROWS = 40, 10


def _escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a faculty of some forty records each: course data, a navigation, a list of lines, two links and a table of counts."""
    p = table(spark, folder, "programs").select("uid", F.lower("faculty_slug").alias("faculty_slug"), "name", "spots_raw", "spots_budget", "spots_tax").where("faculty_slug IS NOT NULL AND name IS NOT NULL").dropDuplicates()
    sizes = p.groupBy("faculty_slug").agg(F.ceil(F.count(F.lit(1)) / PAGE_RECORDS).alias("n"))
    p = p.join(sizes, "faculty_slug").withColumn("no", F.pmod(F.conv(F.left(F.md5("uid"), F.lit(8)), 16, 10).cast("long"), F.col("n")))
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    item = F.concat(F.lit("<li>"), _escaped(F.coalesce("spots_raw", "name")), F.lit("</li>"))
    row = F.concat(F.lit("<tr><td>"), _escaped(F.col("name")), F.lit("</td><td>"), said("spots_budget"), F.lit("</td><td>"), said("spots_tax"), F.lit("</td></tr>"))
    g = p.groupBy("faculty_slug", "no").agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"), F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"), F.array_sort(F.collect_set("name")).alias("names"))
    courses = F.to_json(F.struct(F.transform("names", lambda n: F.struct(n.alias("name"))).alias("hasCourse")))
    text = F.concat(
        F.lit("<html><head><script type=\"application/ld+json\">"), courses, F.lit("</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Admitere</h1><ul>"), F.col("items"),
        F.lit("</ul><a href='/docs/cifra.pdf'>Cifra 2026</a> <a href='rezultate.PDF'>Rezultate admitere</a><table><tr><th>Specializare</th><th>Buget</th><th>Taxa</th></tr>"), F.col("rows"), F.lit("</table></article></body></html>"),
    )
    url = F.concat(F.lit("https://"), F.regexp_replace("faculty_slug", "-", "."), F.lit(".example/admitere/licenta/"), F.col("no").cast("string"))
    return g.select(F.concat_ws("/", "faculty_slug", F.col("no").cast("string")).alias("page_id"), url.alias("url"), "faculty_slug", text.alias("html"))


def page_programmes(spark: SparkSession, folder: str) -> DataFrame:
    return html.programmes(pages(spark, folder))


def fallback_programmes(spark: SparkSession, folder: str) -> DataFrame:
    """ST6: two thirds of the pages came without content and have rendered copies."""
    every = pages(spark, folder)
    empty = F.crc32("page_id") % 3 > 0
    fetched = every.withColumn("html", F.when(empty, F.when(F.crc32("page_id") % 3 == 1, F.lit("<html><body>loading</body></html>"))).otherwise(F.col("html")))
    return html.with_fallback(fetched, every)


def page_tables(spark: SparkSession, folder: str) -> DataFrame:
    return html.table_programmes(html.dom_nodes(pages(spark, folder))).select("source_url", "name", "spots_budget", "spots_tax", "spots_raw", "accuracy_confidence")


def page_lists(spark: SparkSession, folder: str) -> DataFrame:
    return html.list_programmes(html.dom_nodes(pages(spark, folder))).select("source_url", "name", "language", "spots_budget", "spots_tax", "spots_raw", "source_type", "accuracy_confidence")


def page_courses(spark: SparkSession, folder: str) -> DataFrame:
    return html.course_programmes(pages(spark, folder)).select("source_url", "name", "uid", "source_type")


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return html.links(html.dom_nodes(pages(spark, folder))).select("page_id", "href", "text", "target", "in_container")


def page_papers(spark: SparkSession, folder: str) -> DataFrame:
    return html.pdf_links(html.dom_nodes(pages(spark, folder))).select("faculty_slug", "pdf_url", "link_text", "source_url", "status")


def page_grade_links(spark: SparkSession, folder: str) -> DataFrame:
    return html.grade_links(html.dom_nodes(pages(spark, folder))).select("url", "href", "score")


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pdf_rows").select("pdf_url", "row_idx", "program_name", "spots_budget", "spots_tax").where("program_name IS NOT NULL").dropDuplicates()
    return rows.withColumn("page_no", F.floor(F.col("row_idx") / PAPER_ROWS).cast("int"))


def _papers(spark: SparkSession, folder: str, line: Column) -> DataFrame:
    g = _numbered(spark, folder).withColumn("line", line).where("line IS NOT NULL").groupBy("pdf_url", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return g.select("pdf_url", "page_no", "text", F.lit(None).cast("array<array<array<string>>>").alias("tables"))


def _line_item() -> Column:
    return F.concat(F.col("program_name"), F.lit(" "), F.col("spots_budget").cast("string"), F.lit(" locuri buget si "), F.col("spots_tax").cast("string"), F.lit(" locuri cu taxa"))


def _rows_of(df: DataFrame) -> DataFrame:
    return df.select("pdf_url", "page", "program_name", "spots_budget", "spots_tax", "source")


def paper_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Names and counts on lines, as stored, those with both counts."""
    return _rows_of(pdf.text_rows(_papers(spark, folder, _line_item())))


def paper_labels(spark: SparkSession, folder: str) -> DataFrame:
    """P5: labelled names with labelled counts."""
    line = F.concat(F.lit("Specializarea: "), F.col("program_name"), F.lit("; Locuri buget: "), F.coalesce("spots_budget", F.lit(0)).cast("string"), F.lit(" Locuri taxa: "), F.coalesce("spots_tax", F.lit(0)).cast("string"), F.lit(" ="))
    return _rows_of(pdf.text_rows(_papers(spark, folder, line)))


def paper_names(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled names in capitals without counts, in recognised text; papers with less than 100 letters of it give none."""
    line = F.concat(F.lit("SPECIALIZAREA: "), F.upper("program_name"), F.lit("\n-"))
    ocr = _papers(spark, folder, line)
    none = ocr.where("false").select("pdf_url", "page_no", "text", "tables")
    return _rows_of(pdf.rows_of_papers(none, ocr))


def paper_fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    """Of each paper the tables, else the text, else the recognised text decide; papers differ in what they have."""
    kind = F.conv(F.left(F.md5("pdf_url"), F.lit(8)), 16, 10).cast("long") % 3
    texts = _papers(spark, folder, _line_item())
    made = _paper_tables(spark, folder).where(kind == 0).unionByName(texts.where(kind == 1))
    return pdf.rows_of_papers(made, texts.where(kind != 1)).select("pdf_url", "program_name", "spots_budget", "spots_tax", "source")


def _paper_tables(spark: SparkSession, folder: str) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    cells = F.array("program_name", said("spots_budget"), F.concat(said("spots_tax"), F.lit(" (2)")))
    g = _numbered(spark, folder).groupBy("pdf_url", "page_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", cells.alias("c")))), lambda x: x["c"]).alias("t"))
    header = F.array(F.array(F.lit("Program de studii"), F.lit("Locuri buget"), F.lit("Locuri cu taxa")))
    return g.select("pdf_url", "page_no", F.lit("Studii de master").alias("text"), F.array(F.concat(header, F.col("t"))).alias("tables"))


def paper_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Table rows as one table per page, with a header, through the table reader."""
    return pdf.rows_of_papers(_paper_tables(spark, folder)).select("pdf_url", "program_name", "spots_budget", "spots_tax", "level")


def grade_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A grade table per page of a paper; only every third row repeats the name."""
    r = _numbered(spark, folder)
    name = F.when(F.col("row_idx") % 3 == 0, F.col("program_name")).otherwise("")
    grade = F.concat((F.lit(4) + F.coalesce("spots_budget", F.lit(0)) % 6).cast("string"), F.lit(","), (F.coalesce("spots_tax", F.lit(0)) % 10).cast("string"))
    rows = r.select("pdf_url", F.lit("paper").alias("context"), F.col("page_no").alias("table_no"), (F.col("row_idx") % PAPER_ROWS + 1).alias("row_no"), F.array(F.col("row_idx").cast("string"), name, grade).alias("cells"))
    heads = r.select("pdf_url", F.col("page_no").alias("table_no")).dropDuplicates().select("pdf_url", F.lit("paper").alias("context"), "table_no", F.lit(0).alias("row_no"), F.array(F.lit("Nr"), F.lit("Program de studii"), F.lit("Medie concurs")).alias("cells"))
    return grades.table_grades(rows.unionByName(heads))


QUERIES = {
    "e20_page_programmes": page_programmes, "st6_fallback": fallback_programmes, "e19_page_tables": page_tables, "e20_page_lists": page_lists, "fn_p18_page_courses": page_courses, "e22_page_links": page_links, "f11_page_papers": page_papers,
    "o4_grade_links": page_grade_links, "fn_p5_paper_labels": paper_labels, "fn_p6_paper_lines": paper_lines, "fn_p7_p8_paper_names": paper_names, "j11_paper_fallbacks": paper_fallbacks, "e16_paper_tables": paper_tables, "e23_w2_grade_tables": grade_tables,
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {_q(w)})" for w in words) + ")"


def _esc(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _flat(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def _edges(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _first(c: str, pattern: str, group: int) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '{pattern}', {group}), '') AS INT)"


_P = f"""p AS (SELECT *, 'https://' || replace(faculty_slug, '-', '.') || '.example/admitere/licenta/' || no AS url, faculty_slug || '/' || no AS page_id FROM (
SELECT d.*, ('0x' || left(md5(uid), 8))::BIGINT % n AS no FROM (SELECT DISTINCT uid, lower(faculty_slug) AS faculty_slug, name, spots_raw, spots_budget, spots_tax FROM programs WHERE faculty_slug IS NOT NULL AND name IS NOT NULL) d
JOIN (SELECT faculty_slug, ceil(count(*) / {PAGE_RECORDS}.0)::BIGINT AS n FROM (SELECT DISTINCT uid, lower(faculty_slug) AS faculty_slug, name, spots_raw, spots_budget, spots_tax FROM programs WHERE faculty_slug IS NOT NULL AND name IS NOT NULL) GROUP BY 1) s ON s.faculty_slug = d.faculty_slug))"""
_HAS = f"(regexp_matches(t, '{BUDGET_PATTERN}') OR regexp_matches(t, '{TAX_PATTERN}'))"
_ITEM_NAME = """CASE WHEN contains(h, ';') THEN trim(split_part(h, ';', 1)) ELSE h END"""
_LANGUAGE = "CASE WHEN contains(lower(name), 'englez') OR contains(lower(name), 'english') THEN 'English' WHEN contains(lower(name), 'francez') THEN 'French' ELSE 'Romanian' END"
_LISTS = f"""li AS (SELECT url, faculty_slug, row_number() OVER (PARTITION BY url ORDER BY x) AS seq, {_flat('v')} AS t, {_edges('v')} AS v FROM (SELECT *, {_esc('coalesce(spots_raw, name)')} AS x, coalesce(spots_raw, name) AS v FROM p)),
ld AS (SELECT *, last_value(CASE WHEN lower(t) LIKE 'domeniul%' THEN trim(string_split(t, 'Domeniul')[-1], ' :') END IGNORE NULLS) OVER (PARTITION BY url ORDER BY seq ROWS UNBOUNDED PRECEDING) AS domain FROM li WHERE t <> ''),
lk AS (SELECT *, CASE WHEN regexp_matches(split_part(t, ',', 2), '\\d') OR contains(lower(split_part(t, ',', 2)), 'locuri') THEN trim(split_part(t, ',', 1)) ELSE t END AS h FROM ld WHERE NOT lower(t) LIKE 'domeniul%' AND NOT (v = '' OR ({_any('lower(v)', NAVIGATION)} AND length(v) < 30))
AND (({_HAS} AND NOT {_any('lower(t)', LIST_NOISE_MORE)}) OR (NOT {_HAS} AND {_any('lower(t)', LIST_WHITELIST)} AND NOT {_any('lower(t)', LIST_NOISE_MORE)} AND length(t) >= 10)) AND NOT regexp_matches(t, '(?i)^(tel|fax|str|bd|nr)\\.?\\s*:')),
ln AS (SELECT url, faculty_slug, seq, {_ITEM_NAME} AS name, domain, {_HAS} AS counted, CASE WHEN regexp_matches(v, '{BOTH_PATTERN}') THEN {_first('v', BOTH_PATTERN, 1)} ELSE {_first('v', BUDGET_PATTERN, 1)} END AS b, CASE WHEN regexp_matches(v, '{BOTH_PATTERN}') THEN {_first('v', BOTH_PATTERN, 2)} ELSE {_first('v', TAX_PATTERN, 1)} END AS tax FROM lk),
lists AS (SELECT url, faculty_slug, 1 AS stage, seq, name, {_LANGUAGE} AS language, b AS spots_budget, tax AS spots_tax, CASE WHEN coalesce(domain, '') <> '' THEN name || ' [Domain: ' || domain || ']' WHEN counted THEN name END AS spots_raw,
CASE WHEN coalesce(b, 0) <> 0 THEN 'html_text_parsed' ELSE 'html_list_mixed' END AS source_type, CASE WHEN coalesce(b, 0) <> 0 THEN 0.8 ELSE 0.5 END::DOUBLE AS accuracy_confidence FROM ln)"""
_TABLES = f"""td AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY x) AS seq FROM (SELECT url, faculty_slug, {_edges('name')} AS c, trim(regexp_replace({_edges('name')}, '\\s+', ' ', 'g')) AS clean, CASE WHEN spots_budget > 0 THEN spots_budget ELSE 0 END AS b, CASE WHEN spots_tax > 0 THEN spots_tax ELSE 0 END AS t,
{_esc('name')} || '</td><td>' || coalesce(spots_budget::VARCHAR, '-') || '</td><td>' || coalesce(spots_tax::VARCHAR, '-') AS x FROM p)),
tf AS (SELECT *, last_value(CASE WHEN lower(clean) LIKE 'domeniul%' THEN trim(string_split(clean, 'Domeniul')[-1], ' :') END IGNORE NULLS) OVER (PARTITION BY url ORDER BY seq ROWS UNBOUNDED PRECEDING) AS domain, CASE WHEN trim(split_part(clean, ':', 1)) = '' THEN clean ELSE trim(split_part(clean, ':', 1)) END AS name FROM td),
tables AS (SELECT url, faculty_slug, 2 AS stage, seq, name, 'Romanian' AS language, b AS spots_budget, t AS spots_tax, 'Table: ' || c || ' | B:' || b || ' T:' || t || CASE WHEN coalesce(domain, '') <> '' THEN ' [Domain: ' || domain || ']' ELSE '' END AS spots_raw, 'html_table_parsed' AS source_type, 0.85::DOUBLE AS accuracy_confidence
FROM tf WHERE NOT lower(clean) LIKE 'domeniul%' AND length(clean) >= 5 AND NOT contains(lower(clean), 'din care') AND (b > 0 OR t > 0 OR {_any('lower(name)', LIST_WHITELIST)}))"""
_COURSES = "courses AS (SELECT url, faculty_slug, 0 AS stage, row_number() OVER (PARTITION BY url ORDER BY name) AS seq, name, 'Romanian' AS language, NULL::INT AS spots_budget, NULL::INT AS spots_tax, NULL::VARCHAR AS spots_raw, 'jsonld' AS source_type, 0.6::DOUBLE AS accuracy_confidence FROM (SELECT DISTINCT url, faculty_slug, name FROM p WHERE name <> ''))"
_HASH = f"sha256({_edges('name')})"
_PROGRAMMES = f"""WITH {_P}, {_LISTS}, {_TABLES}, {_COURSES}, u AS (SELECT * FROM courses UNION ALL SELECT * FROM lists UNION ALL SELECT * FROM tables)
SELECT sha256(url || '|' || {sql_slug('name')}) AS uid, url AS source_url, name, sha256('faculty:' || faculty_slug) AS faculty_uid, faculty_slug, CASE WHEN contains(url, 'licenta') THEN 'Licenta' ELSE 'Master' END AS level, CASE WHEN contains(url, 'licenta') THEN '4 ani' ELSE '2 ani' END AS duration_years,
language, {_HASH} AS content_hash, spots_budget, spots_tax, spots_raw, source_type, accuracy_confidence FROM u QUALIFY row_number() OVER (PARTITION BY sha256(url || '|' || {sql_slug('name')}) ORDER BY stage DESC, seq DESC) = 1"""
_LINKS = f"WITH {_P}, g AS (SELECT DISTINCT page_id, url, faculty_slug FROM p)"
_ROWS = f"r AS (SELECT DISTINCT pdf_url, row_idx, program_name, spots_budget, spots_tax, floor(row_idx / {PAPER_ROWS}.0)::INT AS page_no FROM pdf_rows WHERE program_name IS NOT NULL)"
_BAD = _any(f"translate(lower(name), {DIA})", ROW_BLACKLIST)


def _texts(line: str) -> str:
    return f"WITH {_ROWS}, l AS (SELECT *, {line} AS line FROM r), g AS (SELECT pdf_url, page_no, string_agg(line, chr(10) ORDER BY row_idx, line) AS text FROM l WHERE line IS NOT NULL GROUP BY ALL)"


def _found(text: str, pattern: str, groups: int) -> str:
    """One row per match of a pattern, in order."""
    parts = ", ".join(f"regexp_extract_all({text}, '{pattern}', {k})[i] AS g{k}" for k in range(1, groups + 1))
    return f"(SELECT pdf_url, page_no, i AS pos, {parts} FROM (SELECT *, unnest(range(1, len(regexp_extract_all({text}, '{pattern}')) + 1)) AS i FROM g))"


_UNBROKEN = "replace(text, '-' || chr(10), '')"
_JOINED = "regexp_replace(replace(replace(" + _edges("translate(text, 'şŞţŢ', 'șȘțȚ')") + ", '-' || chr(10), ''), chr(10), ' '), '\\s+', ' ', 'g')"
#: The labelled pattern without its look-ahead: the first "Locuri" behind the name is that of the counts, or stands before it.
_LABELLED = rf"(?i)(?:Specializarea|Programul|Domeniul|DISCIPLINA)\s*[:\-]?\s*({pdf._NAME})\s*[;|]?\s*(?:Locuri[\s\S]{{0,294}}?)??Locuri\s*buget\s*[:\-]?\s*(\d+)[\s\S]{{0,100}}?Locuri\s*tax[aă]\s*[:\-]?\s*(\d+)"
_LINE_ITEM = "program_name || ' ' || spots_budget || ' locuri buget si ' || spots_tax || ' locuri cu taxa'"

_TEXT_ROWS = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pdf_url, name ORDER BY page_no, pos) AS n FROM f WHERE length(name) > 5) WHERE n = 1 AND NOT {_BAD})"
_TABLE_ROWS = f"(SELECT pdf_url, name AS program_name, coalesce(spots_budget, spots_tax) AS spots_budget, spots_tax FROM (SELECT *, trim(program_name) AS name FROM r) WHERE length(name) >= 3 AND NOT {_BAD} AND (spots_budget IS NOT NULL OR spots_tax IS NOT NULL OR length(name) > 5))"

SQL = {
    "e20_page_programmes": _PROGRAMMES,
    "st6_fallback": _PROGRAMMES,
    "e19_page_tables": f"WITH {_P}, {_TABLES} SELECT url AS source_url, name, spots_budget, spots_tax, spots_raw, accuracy_confidence FROM tables",
    "e20_page_lists": f"WITH {_P}, {_LISTS} SELECT url AS source_url, name, language, spots_budget, spots_tax, spots_raw, source_type, accuracy_confidence FROM lists",
    "fn_p18_page_courses": f"WITH {_P}, {_COURSES} SELECT url AS source_url, name, sha256(url || '|' || {sql_slug('name')}) AS uid, source_type FROM courses",
    "e22_page_links": f"{_LINKS}, origin AS (SELECT *, regexp_extract(url, '^(https://[^/]*)', 1) AS o FROM g) SELECT page_id, '/' AS href, 'Home' AS text, o || '/' AS target, false AS in_container FROM origin UNION ALL SELECT page_id, '/docs/cifra.pdf', 'Cifra 2026', o || '/docs/cifra.pdf', true FROM origin UNION ALL SELECT page_id, 'rezultate.PDF', 'Rezultate admitere', o || '/admitere/licenta/rezultate.PDF', true FROM origin",
    "f11_page_papers": f"{_LINKS} SELECT faculty_slug, regexp_extract(url, '^(https://[^/]*)', 1) || x.path AS pdf_url, x.said AS link_text, url AS source_url, 'queued' AS status FROM g, (VALUES ('/docs/cifra.pdf', 'Cifra 2026'), ('/admitere/licenta/rezultate.PDF', 'Rezultate admitere')) x(path, said)",
    "o4_grade_links": f"{_LINKS} SELECT url, x.href, x.score FROM g, (VALUES ('/docs/cifra.pdf', 5), ('rezultate.PDF', 10)) x(href, score)",
    "fn_p6_paper_lines": f"""{_texts(_LINE_ITEM)}, f AS (SELECT pdf_url, page_no, pos, trim(g1) AS name, g2, g3 FROM {_found(_UNBROKEN, pdf.LINE_ITEM, 3)})
SELECT pdf_url, page_no AS page, name AS program_name, try_cast(g2 AS INT) AS spots_budget, try_cast(g3 AS INT) AS spots_tax, 'text' AS source FROM {_TEXT_ROWS}""",
    "j11_paper_fallbacks": f"""{_texts(_LINE_ITEM)}, f AS (SELECT pdf_url, page_no, pos, trim(g1) AS name, g2, g3, ('0x' || left(md5(pdf_url), 8))::BIGINT % 3 AS kind FROM {_found(_UNBROKEN, pdf.LINE_ITEM, 3)}),
t AS (SELECT * FROM {_TABLE_ROWS} WHERE ('0x' || left(md5(pdf_url), 8))::BIGINT % 3 = 0)
SELECT *, 'table' AS source FROM t UNION ALL SELECT pdf_url, name, try_cast(g2 AS INT), try_cast(g3 AS INT), CASE WHEN kind = 1 THEN 'text' ELSE 'ocr' END FROM {_TEXT_ROWS}
WHERE kind = 1 OR (pdf_url NOT IN (SELECT pdf_url FROM t) AND pdf_url IN (SELECT pdf_url FROM g GROUP BY 1 HAVING sum(length(text)) > 100))""",
    "fn_p5_paper_labels": f"""{_texts("'Specializarea: ' || program_name || '; Locuri buget: ' || coalesce(spots_budget, 0) || ' Locuri taxa: ' || coalesce(spots_tax, 0) || ' ='")}, f AS (SELECT pdf_url, page_no, 1 AS rank, pos, trim(g1) AS name, g2, g3 FROM {_found(_JOINED, _LABELLED, 3)}
UNION ALL SELECT pdf_url, page_no, 3, pos, trim(g1), NULL, NULL FROM {_found(_UNBROKEN, pdf.NAME_ONLY, 1)} WHERE length(trim(g1)) > 5 AND NOT contains(upper(g1), 'MASTER') AND NOT contains(upper(g1), 'AGRONOMIE'))
SELECT pdf_url, page_no AS page, name AS program_name, try_cast(g2 AS INT) AS spots_budget, try_cast(g3 AS INT) AS spots_tax, 'text' AS source FROM (SELECT *, row_number() OVER (PARTITION BY pdf_url, name ORDER BY page_no, rank, pos) AS n FROM f) WHERE (rank = 1 OR n = 1) AND NOT {_BAD}""",
    "fn_p7_p8_paper_names": f"""{_texts("'SPECIALIZAREA: ' || upper(program_name) || chr(10) || '-'")}, f AS (SELECT pdf_url, page_no, pos, trim(g1) AS name FROM {_found(_UNBROKEN, pdf.NAME_ONLY, 1)} WHERE pdf_url IN (SELECT pdf_url FROM g GROUP BY 1 HAVING sum(length(text)) > 100))
SELECT pdf_url, page_no AS page, name AS program_name, NULL::INT AS spots_budget, NULL::INT AS spots_tax, 'ocr' AS source FROM (SELECT *, row_number() OVER (PARTITION BY pdf_url, name ORDER BY page_no, pos) AS n FROM f WHERE length(name) > 5 AND NOT contains(upper(name), 'MASTER') AND NOT contains(upper(name), 'AGRONOMIE')) WHERE n = 1 AND NOT {_BAD}""",
    "e16_paper_tables": f"WITH {_ROWS} SELECT *, 'Master' AS level FROM {_TABLE_ROWS}",
    "e23_w2_grade_tables": f"""WITH {_ROWS} SELECT pdf_url, coalesce(last_value(CASE WHEN row_idx % 3 = 0 AND length(trim(program_name)) > 5 THEN trim(program_name) END IGNORE NULLS) OVER (PARTITION BY pdf_url, page_no ORDER BY row_idx ROWS UNBOUNDED PRECEDING), 'paper') AS program_name,
((4 + coalesce(spots_budget, 0) % 6) || '.' || (coalesce(spots_tax, 0) % 10))::DOUBLE AS grade FROM r""",
}
