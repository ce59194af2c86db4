"""Ranking of candidate papers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.functions.vocab import AGAINST, DOCUMENT_TYPES, GRADE_LINK_AGAINST, GRADE_LINK_WORDS
from admitta.operators.ranking import salted_rank

#: Input positions in one cell of a ranking.
STRETCH = 100_000


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """One pattern for all words, so that the plan stays small."""
    return c.rlike("|".join(map(re.escape, words)))


def metadata_score(link_text: Column, url: Column, year: int, target: str = "SPOTS", types: Mapping[str, Sequence[str]] = DOCUMENT_TYPES) -> Column:
    """Points for the year, the wanted type, and against other types and calendars."""
    text, link = F.lower(F.coalesce(link_text, F.lit(""))), F.lower(F.coalesce(url, F.lit("")))
    has = lambda y: F.contains(text, F.lit(str(y))) | F.contains(link, F.lit(str(y)))
    against = [w for t in AGAINST.get(target, []) for w in types[t]]
    wanted = contains_any(text, types[target]) | contains_any(link, types[target]) if target in types else F.lit(False)
    return (
        F.when(has(year), 10.0).when(has(year - 1), 8.0 if target == "RESULTS" else 5.0).otherwise(0.0)
        + F.when(wanted, 15.0).otherwise(0.0)
        - F.when(contains_any(text, against), 10.0).otherwise(0.0)
        - F.when(contains_any(text, types["CALENDAR"]), 20.0).otherwise(0.0)
    )


def _scored(queue: DataFrame, year: int, target: str) -> DataFrame:
    address = F.coalesce("pdf_url", "url")
    able = queue.where((F.coalesce("link_text", F.lit("")) != "") & (F.coalesce(address, F.lit("")) != ""))  # F12
    return able.withColumn("stage_a_score", metadata_score(F.col("link_text"), address, year, target)).withColumn("address", address)


def ranked_queue(queue: DataFrame, year: int, target: str = "SPOTS") -> DataFrame:
    """Candidates that have a text and an address, scored, with their place in the faculty (O1; ties in input order).

    The places come from cells of one score and a stretch of the input, so a faculty of any size is
    ranked by many tasks.
    """
    cells = _scored(queue, year, target).withColumn("_worse", -F.col("stage_a_score")).withColumn("_stretch", F.floor(F.col("input_pos") / STRETCH))
    ranked = salted_rank(cells, ["faculty_slug"], ["_worse", "_stretch"], ["input_pos", "address"])
    return ranked.withColumn("place", (F.col("rank0") + 1).cast("int")).drop("_worse", "_stretch", "rank0")


def best_papers(queue: DataFrame, year: int, k: int = 3, target: str = "SPOTS") -> DataFrame:
    """O2: the best k per faculty. The limit is pushed below the shuffle, k rows a faculty and task."""
    place = Window.partitionBy("faculty_slug").orderBy(F.desc("stage_a_score"), "input_pos", "address")
    return _scored(queue, year, target).withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def content_score(pages: DataFrame, year: int) -> DataFrame:
    """E15 over (pdf_url, page_no, text, tables): what the first two pages hold, and the points for it."""
    first = pages.where("page_no <= 2").withColumn("text", F.coalesce("text", F.lit("")))
    hits = F.size(F.regexp_extract_all("text", F.lit(r"(?i)(\d+\s+(?:loc|buget|tax))"), F.lit(1)))
    found = first.groupBy("pdf_url").agg(
        F.count(F.lit(1)).alias("sampled_pages"), F.sum(F.length("text")).alias("chars"), F.sum(hits).alias("rows_with_numbers"),
        F.bool_or(F.coalesce(F.size("tables") > 0, F.lit(False))).alias("has_table"), F.bool_or(F.contains("text", F.lit(str(year)))).alias("has_year"),
    )
    density = F.col("chars") / F.greatest(F.lit(1), F.col("sampled_pages"))
    points = F.when(density < 50, -2.0).otherwise(5.0) + F.when(F.col("rows_with_numbers") > 0, 10.0 + F.least("rows_with_numbers", F.lit(10))).otherwise(0.0) + F.when(F.col("has_table"), 5.0).otherwise(0.0)
    return found.select("pdf_url", density.alias("text_density"), "has_table", "rows_with_numbers", F.when(F.col("has_year"), year).alias("detected_year"), points.alias("content_score"))


def trusted_papers(rows: DataFrame, least_share: float = 0.5, least_score: float = -5.0) -> DataFrame:
    """Papers (pdf_url, n_rows, n_valid) with enough rows that could be programmes, and not too low a score."""
    valid = (F.length("program_name") > 5) & ~F.contains(F.lower("program_name"), F.lit("copie"))
    counts = rows.groupBy("pdf_url").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(valid, F.lit(False))).alias("n_valid"), F.max("content_score").alias("score"))
    ok = (F.col("n_valid") > 0) & (F.col("n_valid") >= least_share * F.col("n_rows")) & ~F.coalesce(F.col("score") < least_score, F.lit(False))
    return counts.where(ok).select("pdf_url", "n_rows", "n_valid")


def grade_link_score(text: Column, href: Column, year: int = 2026) -> Column:
    """F13."""
    low = F.lower(text)
    dated = F.contains(low, F.lit(str(year))) | F.contains(href, F.lit(str(year)))
    return F.when(contains_any(low, GRADE_LINK_WORDS), 10).otherwise(0) - F.when(contains_any(low, GRADE_LINK_AGAINST), 100).otherwise(0) + F.when(dated, 5).otherwise(0)
