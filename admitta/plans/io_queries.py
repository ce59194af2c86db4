"""Queries that write the tables through a sink and read them again through a source; their SQL is the table itself."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.functions import identity
from admitta.operators import coverage, publish
from admitta.session import read_text, shared_path, write_text
from admitta.sources import files, web
from admitta.sources.tables import table
from admitta.streaming import queue

_KEPT = ("uid", "run_id", "scraped_at", "name", "level", "faculty_slug", "program_id", "spots_raw", "admission_year", "spots_budget", "spots_tax", "source_type")


def _programs(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "programs").withColumn("entity_type", F.lit("program"))
    return p.select([f.name for f in spark.createDataFrame([], files.PROGRAM).schema])


def programs_json(spark: SparkSession, folder: str) -> DataFrame:
    """SC1, SK2, SK10: all records as JSON lines and back, evidence and metadata included."""
    path = shared_path(spark, "programs-json")
    publish.write_json(_programs(spark, folder), path)
    back = files.programs_json(spark, f"{path}/*.json", lines=True)
    evidence = F.transform(F.coalesce(F.col("evidence")["spots"], F.array().cast(back.schema["evidence"].dataType.valueType)), lambda e: F.concat_ws("/", e["source"], e["value"]["budget"], e["value"]["tax"], e["page"]))
    return back.select(*_KEPT, F.array_join(evidence, ",").alias("spots_evidence"), F.col("metadata.match_status").alias("match_status"), F.array_join("keywords", ",").alias("keywords"))


def run_programs(spark: SparkSession, folder: str) -> DataFrame:
    """SC3, SC4, SK3: a run in folders of its faculties; all of it, with one faculty read on its own."""
    path = shared_path(spark, "run")
    publish.write_json(_programs(spark, folder).withColumn("faculty", F.lower("faculty_slug")), f"{path}/raw", ["faculty"])
    every = files.programs_of(spark, path, layout="faculty={}", lines=True).select("uid", "name", F.lit("run").alias("part"))
    one = files.programs_of(spark, path, "teh-corveni", layout="faculty={}", lines=True).select("uid", "name", F.lit("faculty").alias("part"))
    return every.unionByName(one)


def json_counts(spark: SparkSession, folder: str) -> DataFrame:
    """SC2, A11: records of broken and whole lines together."""
    path = shared_path(spark, "broken-json")
    whole = _programs(spark, folder).select(F.to_json(F.struct("uid", "name", "entity_type")).alias("value"))
    whole.unionByName(table(spark, folder, "pdf_rows").select(F.concat(F.lit('{"uid": '), F.coalesce("program_name", F.lit("?"))).alias("value")).withColumn("value", F.regexp_replace("value", r"\s+", " "))).write.text(path)
    back = files.programs_json(spark, f"{path}/*", lines=True)
    return coverage.counts(back.withColumn("file", F.lit(path))).select("records")


def flat_csv(spark: SparkSession, folder: str) -> DataFrame:
    """SC5, SK1: the flat export as CSV and back; the reader gives text."""
    path = shared_path(spark, "export-csv")
    flat = publish.flat(table(spark, folder, "programs"))
    publish.write_csv(flat.select("name", "level", "faculty_slug", "duration_years", "spots_budget", "spots_tax", "source_type", "url"), path)
    return files.exported_csv(spark, path)


def manifest_faculties(spark: SparkSession, folder: str) -> DataFrame:
    """SC6, SK9: the manifest of a run, written and read; the second part lists a run without one by its files."""
    path = shared_path(spark, "manifest")
    outcomes = table(spark, folder, "pdf_queue").select(F.lower("faculty_slug").alias("faculty_slug"), F.when(F.col("status") == "done", "OK").otherwise("ERROR").alias("status"))
    publish.write_manifest(publish.manifest(outcomes, "run", "2026-01-01", "2026-01-02"), f"{path}/manifest.json")
    publish.write_json(table(spark, folder, "faculties").select("name", F.col("slug").alias("faculty")), f"{path}/files/raw", ["faculty"])
    return files.run_faculties(spark, path).withColumn("part", F.lit("manifest")).unionByName(files.run_faculties(spark, f"{path}/files").withColumn("part", F.lit("files")))


def html_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """SC7, SK8: one HTML file per faculty with its address on the first line."""
    path = shared_path(spark, "html")
    f = table(spark, folder, "faculties")
    url = F.get("urls", F.lit(0))
    page = F.concat(F.lit("<!-- Source: "), url, F.lit(" -->\n<html><h1>"), F.col("name"), F.lit("</h1>\n<p>"), F.array_join("urls", " "), F.lit("</p></html>"))
    f.where("size(urls) > 0").select(F.col("slug").alias("faculty"), page.alias("value")).write.partitionBy("faculty").text(f"{path}/raw")
    back = files.snapshots(spark, f"{path}/raw/*/*.txt")
    return back.select(F.regexp_replace("faculty_slug", "^faculty=", "").alias("faculty_slug"), "url", F.trim(F.regexp_replace("html", r"\s+", " ")).alias("html"))


def latest_map(spark: SparkSession, folder: str) -> DataFrame:
    """SC8: grade maps written one after the other; the latest one is read."""
    path = shared_path(spark, "grades-map")
    for name in ("b", "c", "a"):
        text = json.dumps({"map": name})
        write_text(spark, f"{path}/grades_map_{name}.json", text)
        while not read_text(spark, f"{path}/grades_map_{name}.json"):
            pass
    latest = files.latest_file(spark, f"{path}/grades_map_*.json")
    return spark.read.schema("map string").json(latest)


def configured(spark: SparkSession, folder: str) -> DataFrame:
    """SC9, O5: the configured faculties from a file, and the first ten of them for a trial run."""
    path = shared_path(spark, "config") + ".yaml"
    listed = [r.asDict() for r in table(spark, folder, "faculties").select("pos", "slug", "name", "urls").orderBy("pos").collect()]  # the configuration: one row per faculty
    write_text(spark, path, json.dumps({"faculties": listed}, ensure_ascii=False))
    every = files.config(spark, path).select("pos", "slug", "name", F.array_join("urls", " ").alias("urls"))
    return every.withColumn("part", F.lit("all")).unionByName(coverage.first_listed(every, "pos", 10).withColumn("part", F.lit("trial")))


def partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """SK5, SK8: records in folders by run and faculty."""
    path = shared_path(spark, "silver")
    p = table(spark, folder, "programs").select("uid", "name", "run_id", "faculty_slug", "spots_budget")
    publish.write_partitioned(p, path)
    return spark.read.schema("uid string, name string, spots_budget int, run_id string, faculty_slug string").parquet(path)


def snapshot_versions(spark: SparkSession, folder: str) -> DataFrame:
    """SK8: every version of a page and the latest one of each address, written by faculty and read."""
    path = shared_path(spark, "snapshots")
    d = table(spark, folder, "documents").select("faculty_slug", "url", F.col("fetched_at").alias("at"), F.md5("text").alias("html"))
    for only_latest, part in ((False, "all"), (True, "latest")):
        publish.write_partitioned(publish.snapshot_rows(d, only_latest).withColumn("part", F.lit(part)), path, ("part", "faculty_slug"))
    return spark.read.schema("url string, at timestamp, html string, file_name string, part string, faculty_slug string").parquet(path).select("url", "html", "file_name", "part", "faculty_slug")


def queue_stream(spark: SparkSession, folder: str) -> DataFrame:
    """ST4: downloads arrive as a stream in several batches; the queue is merged with each and read at the end."""
    path = shared_path(spark, "queue")
    q = table(spark, folder, "pdf_queue").dropDuplicates(["input_pos"])
    results = q.where("status IN ('queued', 'pending') AND coalesce(pdf_url, url) IS NOT NULL").select(F.coalesce("pdf_url", "url").alias("address"), F.lit(1).alias("seq"), F.lit("downloaded").alias("status"), identity.pdf_name(F.coalesce("pdf_url", "url"), "spots").alias("local_path"))
    results.repartition(3, "address").write.parquet(f"{path}/results")
    queue.start(spark, q, f"{path}/state")
    stream = spark.readStream.schema("address string, seq int, status string, local_path string").option("maxFilesPerTrigger", 1).parquet(f"{path}/results")
    queue.merged(stream, f"{path}/state").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return queue.current(spark, f"{path}/state").select("input_pos", "status", "local_path")


def errors(spark: SparkSession, folder: str) -> DataFrame:
    """SK7: what could not be fetched, as rows of errors, written and read."""
    path = shared_path(spark, "errors")
    q = table(spark, folder, "pdf_queue").select("faculty_slug", F.coalesce("pdf_url", "url").alias("url"), "status", F.lit(None).cast("string").alias("message"), F.col("link_text").alias("content"))
    publish.write_json(publish.error_rows(q), path)
    return spark.read.schema("faculty_slug string, url string, error string, raw string, key string").json(path)


def stored_names(spark: SparkSession, folder: str) -> DataFrame:
    """SC14, SC15: safe file names, and papers that are there already left out of the download."""
    q = table(spark, folder, "pdf_queue").select(F.coalesce("pdf_url", "url").alias("url"), "link_text", "status").where("url IS NOT NULL").dropDuplicates()
    due = web.not_stored(q, q.where("status = 'done'").select("url"), "url")
    return due.select("url", web.safe_file_name(F.concat(F.coalesce("link_text", F.lit("")), F.lit(".pdf"))).alias("file_name"), web.stored_name(F.encode("url", "UTF-8")).alias("stored_name")).dropDuplicates()


def _answers() -> web.PoliteFetcher:
    """A fetcher without a network: what a server says follows from the address."""
    from hashlib import md5

    def get(url: str) -> web.Answer:
        digit = md5(url.encode()).hexdigest()[0]
        if digit in "0123":
            return web.Answer(404)
        return web.Answer(200, url.encode(), "text/html" if digit == "4" else "application/pdf")

    return web.PoliteFetcher(get, wanted="pdf", polite=None, wait=lambda _: None)


def fetched(spark: SparkSession, folder: str) -> DataFrame:
    """SC10, SC11, SC13, ST3, F14: addresses that wait for their download, fetched in lanes of whole hosts; a host is left alone after three failures in a row."""
    found = web.fetch(web.due(table(spark, folder, "pdf_queue")), _answers)
    return found.select("url", "status", "code", F.md5("content").alias("content_md5"), "tries")


def paper_texts(spark: SparkSession, folder: str) -> DataFrame:
    """SC15, SC16: papers whose bytes are the lines of their rows; a paper that starts with a digit can't be read."""
    rows = table(spark, folder, "pdf_rows").where("program_name IS NOT NULL").select("pdf_url", (F.floor(F.col("row_idx") / 20)).alias("part"), "row_idx", F.regexp_replace("program_name", r"\s+", " ").alias("line")).dropDuplicates()
    papers = rows.groupBy("pdf_url", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "line"))), lambda x: x["line"]), "\n").alias("text"))

    def extract(content: bytes) -> list[tuple[str, list]]:
        text = content.decode("utf-8")
        if text[:1].isdigit():
            raise ValueError("no paper")
        lines = text.split("\n")
        return [("\n".join(lines[i : i + 5]), [[[x] for x in lines[i : i + 5]]]) for i in range(0, len(lines), 5)]

    files = papers.select(F.concat_ws("#", "pdf_url", F.col("part").cast("string")).alias("pdf_url"), F.encode("text", "UTF-8").alias("content"))
    return web.paper_pages(files, extract).select("pdf_url", "page_no", "text", F.size(F.get("tables", F.lit(0))).cast("long").alias("table_rows"), "error").withColumn("table_rows", F.when(F.col("table_rows") >= 0, F.col("table_rows")))


def newest_run(spark: SparkSession, folder: str) -> DataFrame:
    """O11."""
    return files.last_run(spark, table(spark, folder, "run_manifests"))


QUERIES = {
    "sc1_sk2_programs_json": programs_json, "sc3_sc4_run_programs": run_programs, "sc2_a11_json_counts": json_counts, "sc5_sk1_flat_csv": flat_csv, "sc6_sk9_manifest": manifest_faculties, "sc7_sk8_snapshots": html_snapshots, "sc8_latest_map": latest_map,
    "sc9_o5_config": configured, "sk5_partitioned": partitioned, "sk7_errors": errors, "sk8_versions": snapshot_versions, "st4_queue_stream": queue_stream, "sc14_stored_names": stored_names, "o11_last_run": newest_run, "sc10_st3_fetched": fetched, "sc15_paper_texts": paper_texts,
}

SQL = {
    "sc1_sk2_programs_json": f"SELECT {', '.join(_KEPT)}, coalesce(array_to_string(list_transform(evidence['spots'], lambda e: concat_ws('/', e.source, e.value.budget, e.value.tax, e.page)), ','), '') AS spots_evidence, metadata.match_status AS match_status, array_to_string(keywords, ',') AS keywords FROM programs WHERE uid IS NOT NULL",
    "sc3_sc4_run_programs": "SELECT uid, name, 'run' AS part FROM programs WHERE uid IS NOT NULL UNION ALL SELECT uid, name, 'faculty' FROM programs WHERE uid IS NOT NULL AND lower(faculty_slug) = 'teh-corveni'",
    "sc2_a11_json_counts": "SELECT count(*) AS records FROM programs WHERE uid IS NOT NULL",
    "sc5_sk1_flat_csv": "SELECT name, level, faculty_slug, duration_years, spots_budget::VARCHAR AS spots_budget, spots_tax::VARCHAR AS spots_tax, coalesce(source_type, 'unknown') AS source_type, source_url AS url FROM programs",
    "sc6_sk9_manifest": "SELECT lower(faculty_slug) AS faculty_slug, 'manifest' AS part FROM pdf_queue GROUP BY 1 HAVING bool_or(coalesce(status = 'done', false)) UNION ALL SELECT DISTINCT slug, 'files' FROM faculties",
    "sc7_sk8_snapshots": "SELECT slug AS faculty_slug, urls[1] AS url, trim(regexp_replace('<!-- Source: ' || urls[1] || ' --> <html><h1>' || name || '</h1> <p>' || array_to_string(urls, ' ') || '</p></html>', '\\s+', ' ', 'g')) AS html FROM faculties WHERE len(urls) > 0",
    "sc8_latest_map": "SELECT 'a' AS map",
    "sc9_o5_config": "SELECT (row_number() OVER (ORDER BY pos) - 1)::INT AS pos, slug, name, array_to_string(urls, ' ') AS urls, 'all' AS part FROM faculties UNION ALL SELECT (row_number() OVER (ORDER BY pos) - 1)::INT, slug, name, array_to_string(urls, ' '), 'trial' FROM faculties QUALIFY row_number() OVER (ORDER BY pos) <= 10",
    "sk5_partitioned": "SELECT uid, name, spots_budget, run_id, faculty_slug FROM programs",
    "sk7_errors": "SELECT faculty_slug, coalesce(pdf_url, url) AS url, coalesce(status, 'unknown') AS error, left(link_text, 100) AS raw, sha256(concat_ws('|', coalesce(pdf_url, url), coalesce(status, 'unknown'))) AS key FROM pdf_queue WHERE status IS NULL OR status NOT IN ('OK', 'done', 'downloaded')",
    "sk8_versions": "WITH n AS (SELECT DISTINCT faculty_slug, url, fetched_at AS tm, md5(text) AS html, strftime(fetched_at, '%H%M%S') || '_' || left(sha256(url), 8) || '_snapshot.html' AS file_name FROM documents WHERE url IS NOT NULL AND fetched_at IS NOT NULL) SELECT url, html, file_name, 'all' AS part, faculty_slug FROM n UNION ALL SELECT url, html, file_name, 'latest', faculty_slug FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY url ORDER BY tm DESC, html DESC NULLS LAST, faculty_slug DESC NULLS LAST) = 1)",
    "st4_queue_stream": "WITH q AS (SELECT DISTINCT ON (input_pos) *, coalesce(pdf_url, url) AS address FROM pdf_queue), w AS (SELECT DISTINCT address FROM q WHERE status IN ('queued', 'pending') AND address IS NOT NULL) SELECT input_pos, CASE WHEN w.address IS NOT NULL THEN 'downloaded' ELSE status END AS status, CASE WHEN w.address IS NOT NULL THEN 'spots_' || left(md5(w.address), 8) || '.pdf' ELSE local_path END AS local_path FROM q LEFT JOIN w ON q.address = w.address",
    "sc14_stored_names": "SELECT DISTINCT u AS url, regexp_replace(coalesce(link_text, '') || '.pdf', '[^\\p{L}\\p{N}._-]', '', 'g') AS file_name, left(sha256(u), 16) || '.pdf' AS stored_name FROM (SELECT coalesce(pdf_url, url) AS u, link_text FROM pdf_queue) WHERE u IS NOT NULL AND u NOT IN (SELECT coalesce(pdf_url, url) FROM pdf_queue WHERE status = 'done' AND coalesce(pdf_url, url) IS NOT NULL)",
    "sc10_st3_fetched": """WITH u AS (SELECT DISTINCT coalesce(pdf_url, url) AS url FROM pdf_queue WHERE status IN ('queued', 'pending') AND coalesce(pdf_url, url) IS NOT NULL), a AS (SELECT url, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host, left(md5(url), 1) AS d FROM u),
n AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY url) AS n, CASE WHEN d IN ('0', '1', '2', '3', '4') THEN 1 ELSE 0 END AS bad FROM a), r AS (SELECT *, sum(bad) OVER (PARTITION BY host ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three FROM n), o AS (SELECT host, min(n) AS stop FROM r WHERE three = 3 GROUP BY host)
SELECT url, CASE WHEN r.n > o.stop THEN 'circuit_open' WHEN bad = 1 THEN 'failed' ELSE 'downloaded' END AS status, CASE WHEN r.n > o.stop THEN NULL WHEN d IN ('0', '1', '2', '3') THEN 404 ELSE 200 END AS code, CASE WHEN coalesce(r.n <= o.stop, true) AND bad = 0 THEN md5(url) END AS content_md5, CASE WHEN r.n > o.stop THEN 0 ELSE 1 END AS tries FROM r LEFT JOIN o ON r.host = o.host""",
    "sc15_paper_texts": """WITH l AS (SELECT DISTINCT pdf_url, floor(row_idx / 20.0)::BIGINT AS part, row_idx, regexp_replace(program_name, '\\s+', ' ', 'g') AS line FROM pdf_rows WHERE program_name IS NOT NULL), n AS (SELECT pdf_url || '#' || part AS pdf_url, line, row_number() OVER (PARTITION BY pdf_url, part ORDER BY row_idx, line) - 1 AS k, row_idx FROM l),
bad AS (SELECT pdf_url FROM n WHERE k = 0 AND regexp_matches(line, '^[0-9]'))
SELECT pdf_url, (k // 5 + 1)::INT AS page_no, string_agg(line, chr(10) ORDER BY k) AS text, count(*) AS table_rows, NULL::VARCHAR AS error FROM n WHERE pdf_url NOT IN (SELECT pdf_url FROM bad) GROUP BY pdf_url, k // 5 UNION ALL SELECT pdf_url, NULL, NULL, NULL, 'ValueError: no paper' FROM bad""",
    "o11_last_run": "SELECT max(run_id) AS run_id FROM run_manifests",
}
