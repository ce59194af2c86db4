"""Flat, nested and retrieval forms (E1 to E7) and the sinks (SK1 to SK10)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.functions.identity import snapshot_name, subdomain
from admitta.functions.parse import count_or_zero, name_language
from admitta.functions.text import display_name
from admitta.functions.vocab import CAREERS_ALL, CAREERS_FIRST, NO_CAREER
from admitta.operators.validate import confidence_label, publishable
from admitta.session import write_text

FLAT = ("name", "level", "faculty_slug", "duration_years", "spots_budget", "spots_tax", "source_type", "accuracy_confidence", "url", "last_admission_grade")


def flat(programs: DataFrame) -> DataFrame:
    """Ten columns with defaults; null counts as absent."""
    return programs.select(
        "name", "level", "faculty_slug", "duration_years", "spots_budget", "spots_tax", F.coalesce("source_type", F.lit("unknown")).alias("source_type"),
        F.coalesce(F.nanvl("accuracy_confidence", F.lit(None).cast("double")), F.lit(0.0)).alias("accuracy_confidence"), F.col("source_url").alias("url"), "last_admission_grade",
    )


def gold(rows: DataFrame, domain: str = "example") -> DataFrame:
    """E2 with F10, F19, N10, P2 and P11: cleaned, nested records fit for publishing."""
    budget, tax = count_or_zero(F.col("spots_budget")), count_or_zero(F.col("spots_tax"))
    confidence = F.coalesce(F.col("accuracy_confidence").cast("string").try_cast("double"), F.lit(0.0))
    return rows.where(publishable(confidence, budget)).select(
        display_name(F.col("name")).alias("program_name"), subdomain(F.col("url"), domain).alias("faculty_code"), F.col("level"), F.struct(budget.alias("budget"), tax.alias("tax")).alias("spots"),
        F.struct(F.col("url"), confidence_label(confidence).alias("confidence"), F.col("source_type")).alias("metadata"),
    )


def _list(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def first_careers(name: Column, table: Mapping[str, Sequence[str]] = CAREERS_FIRST) -> Column:
    """The careers of the first key the name holds."""
    low = F.lower(name)
    return F.coalesce(*(F.when(F.contains(low, F.lit(k)), _list(v)) for k, v in table.items()), _list(NO_CAREER))


def all_careers(name: Column, table: Mapping[str, Sequence[str]] = CAREERS_ALL) -> Column:
    """The careers of all keys the name holds, each once, sorted."""
    low, none = F.lower(name), F.array().cast("array<string>")
    found = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.when(F.contains(low, F.lit(k)), _list(v)).otherwise(none) for k, v in table.items())))))
    return F.when(F.size(found) > 0, found).otherwise(_list(NO_CAREER))


def requirements(level: Column) -> Column:
    """E5."""
    return F.when(F.contains(F.lower(F.coalesce(level, F.lit(""))), F.lit("master")), _list(["Media Licență (Probabil Interviu)"])).otherwise(_list(["Dosar (Medie Bac)"]))


def keywords(name: Column, faculty: Column) -> Column:
    """Name, faculty, words and domain words of more than two letters, in lower case, each once, sorted."""
    low, none = F.lower(F.coalesce(name, F.lit(""))), F.array().cast("array<string>")
    words = F.concat(
        F.array(name, faculty), F.split(low, r"\s+"), F.when(F.contains(low, F.lit("calc")), _list(["computer science", "it", "programare"])).otherwise(none),
        F.when(F.contains(low, F.lit("auto")), _list(["control engineering", "robotics"])).otherwise(none), F.when(name_language(name, True) == "en", _list(["international"])).otherwise(none),
    )
    return F.array_sort(F.array_distinct(F.transform(F.filter(words, lambda w: w.isNotNull() & (F.length(w) > 2)), lambda w: F.lower(w))))


def retrieval_text(programs: DataFrame, year: int, prefix: str) -> DataFrame:
    """E7 with P14, E4 to E6 and N15: uid, stable id beginning with ``prefix``, language, keywords, careers and the text in three blocks."""
    said = lambda c, default: F.coalesce(c.cast("string"), F.lit(default))
    lang, careers, words = name_language(F.col("name"), True), all_careers(F.col("name")), keywords(F.col("name"), F.col("faculty_slug"))
    facts = F.concat_ws(
        "\n", F.concat(F.lit("Program: "), "name"), F.concat(F.lit("Nivel: "), said(F.col("level"), "Licenta")), F.concat(F.lit("Facultate: "), F.upper("faculty_slug")), F.concat(F.lit("Durata: "), said(F.col("duration_years"), "N/A")),
        F.concat(F.lit("Limba: "), F.upper(lang)), F.concat(F.lit(f"Locuri Buget ({year}): "), said(F.col("spots_budget"), "N/A")), F.concat(F.lit(f"Locuri Taxa ({year}): "), said(F.col("spots_tax"), "N/A")),
    )
    inferred = F.concat_ws("\n", F.concat(F.lit("Cariera: "), F.array_join(careers, ", ")), F.concat(F.lit("Admitere: "), F.array_join(requirements(F.col("level")), ", ")), F.concat(F.lit("Keywords: "), F.array_join(words, ", ")))
    text = F.concat(F.lit("[FACTS]\n"), facts, F.lit("\n\n[INFERRED]\n"), inferred, F.lit("\n\n[PROVENANCE]\nSource: "), said(F.col("source_url"), "N/A"))
    return programs.select("uid", F.concat_ws("_", F.lit(prefix), "faculty_slug", F.left("uid", F.lit(8))).alias("program_id"), lang.alias("language"), words.alias("keywords"), careers.alias("career_paths"), text.alias("text_for_embedding"))


def upsert(existing: DataFrame, arriving: DataFrame, key: str = "uid", order: str = "seq") -> DataFrame:
    """SK5, W6: one row per key, the last by ``order``; arriving rows follow the existing ones."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(arriving.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc_nulls_last(order))
    return both.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_new")


def quarantine(rows: DataFrame, name: str = "program_name") -> DataFrame:
    """SK6: quarantined rows (with ``check``), one per name, keyed by its hash; the last by paper and row stays."""
    keyed = rows.withColumn("key", F.sha2(F.col(name), 256))
    order = F.struct(F.col("pdf_url"), F.col("row_idx"))
    return keyed.groupBy("key").agg(F.max_by(F.struct(F.col(name).alias("name"), F.col("check.reason").alias("reason"), F.col("check.score").alias("score"), "raw_row"), order).alias("q")).select("key", "q.*")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """SK1: a header and rows, in parallel; ``one_file`` for readers of small exports that expect a single file."""
    out = (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"')
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """SK2, SK3, SK4, SK10: JSON lines in parallel, timestamps in full; ``by`` makes folders."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("ignoreNullFields", False).partitionBy(*by).json(path)


def error_rows(outcomes: DataFrame, at: str | None = None, raw: int = 100) -> DataFrame:
    """SK7: (faculty_slug, url, error, raw, key) of (faculty_slug, url, status, message, content) that failed.

    ``raw`` characters of the content are kept; the key is the hash of address and message, so that an
    error met again replaces itself. ``at`` adds the time of the run.
    """
    bad = outcomes.where(~F.col("status").isin("OK", "done", "downloaded") | F.col("status").isNull())
    message = F.coalesce("message", F.coalesce("status", F.lit("unknown")))
    rows = bad.select("faculty_slug", "url", message.alias("error"), F.substring("content", 1, raw).alias("raw"), F.sha2(F.concat_ws("|", "url", message), 256).alias("key"))
    return rows if at is None else rows.withColumn("failed_at", F.lit(at).cast("timestamp"))


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("run_id", "faculty_slug")) -> None:
    """SK5, SK7, SK8: Parquet by run and faculty; a hot faculty spreads over files by the hash of its rows."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def snapshot_rows(pages: DataFrame, only_latest: bool = False) -> DataFrame:
    """SK8: pages (faculty_slug, url, at, html) with the name of their file, every version or only the latest of each address.

    Written with ``write_partitioned``. Pages without address or time have no name and are left out; of
    versions of one time the largest text stays.
    """
    named = pages.where("url IS NOT NULL AND at IS NOT NULL").withColumn("file_name", snapshot_name(F.col("at"), F.sha2("url", 256)))
    if not only_latest:
        return named.dropDuplicates()
    rest = [c for c in named.columns if c != "url"]
    return named.groupBy("url").agg(F.max_by(F.struct(*rest), F.struct("at", "html", "faculty_slug")).alias("p")).select("url", "p.*")


def manifest(outcomes: DataFrame, run_id: str, started_at: str, finished_at: str) -> DataFrame:
    """Totals of a run from (faculty_slug, status); a faculty is successful when an address was fetched."""
    ok = outcomes.groupBy("faculty_slug").agg(F.bool_or(F.col("status") == "OK").alias("ok"))
    return ok.agg(F.lit(run_id).alias("run_id"), F.lit(started_at).alias("started_at"), F.lit(finished_at).alias("finished_at"), F.count(F.lit(1)).alias("faculties_total"), F.array_sort(F.collect_list(F.when(F.col("ok"), F.col("faculty_slug")))).alias("successful"))


def write_manifest(row: DataFrame, path: str) -> None:
    """SK9: one JSON object; the manifest is a single row."""
    write_text(row.sparkSession, path, json.dumps(row.first().asDict(recursive=True), ensure_ascii=False, indent=1, default=str))
