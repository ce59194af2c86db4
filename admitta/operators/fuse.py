"""Evidence, arbitration and narrative texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitta.functions.identity import faculty_uid, program_id, uid
from admitta.functions.parse import study_level
from admitta.functions.text import snippet

#: Share of the match and of the source in the likelihood, and the tiers of content scores.
MATCH_SHARE, SOURCE_SHARE, TOP_TIER, MIDDLE_TIER, LOW_TIER = 0.6, 0.4, 0.9, 0.7, 0.5
MATCH_WEIGHT, PDF_ONLY_PRIORITY = 10, 0.8


def source_priority(content_score: Column) -> Column:
    """E12."""
    return F.when(content_score > 10, TOP_TIER).when(content_score > 0, MIDDLE_TIER).otherwise(LOW_TIER)


def likelihood(match: Column, priority: Column) -> Column:
    """Match scores above 1 are percentages; both are kept within 0 and 1."""
    unit = F.when(match > 1.0, match / 100.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), match)))
    return F.round(MATCH_SHARE * unit + SOURCE_SHARE * priority, 4)


def extraction_confidence(source_type: Column, budget: Column) -> Column:
    """E10."""
    listed = F.when(F.coalesce(budget, F.lit(0)) != 0, 0.8).otherwise(0.5)
    return F.when(source_type == "html_table_parsed", 0.85).when(source_type == "jsonld", 0.6).otherwise(listed)


def collect_evidence(matches: DataFrame, keys: list[str]) -> DataFrame:
    """A4: the items of each record in the order of their sources (pdf_rank, then row_idx and address)."""
    item = F.struct(
        F.col("pdf_rank"), F.col("row_idx"), F.col("pdf_url").alias("source"), F.col("source_name"), F.struct(F.col("spots_budget").alias("budget"), F.col("spots_tax").alias("tax")).alias("value"),
        F.col("content_score").alias("score"), F.col("match_score"), likelihood(F.col("match_score"), source_priority(F.col("content_score"))).alias("likelihood_score"),
        F.coalesce(F.col("page"), F.lit(1)).alias("page"), snippet(F.coalesce(F.col("raw_row"), F.lit(""))).alias("snippet"),
    )
    return matches.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda e: e.dropFields("pdf_rank", "row_idx")).alias("spots_evidence"))


def arbitrate(matches: DataFrame, keys: list[str]) -> DataFrame:
    """A5: the item with the largest content score plus ten times the match; the earlier source wins ties.

    The choice does not depend on the order of arrival.
    """
    total = F.coalesce(F.col("content_score"), F.lit(0.0)) + MATCH_WEIGHT * F.col("match_score")
    order = F.struct(total.alias("t"), (-F.coalesce("pdf_rank", F.lit(2**31 - 1))).alias("r"), (-F.coalesce("row_idx", F.lit(2**31 - 1))).alias("i"), F.col("pdf_url").alias("u"))
    best = F.struct(total.alias("best_source_score"), "match_score", "spots_budget", "spots_tax", "pdf_url", "row_idx", likelihood(F.col("match_score"), source_priority(F.col("content_score"))).alias("accuracy_confidence"))
    return matches.groupBy(*keys).agg(F.max_by(best, order).alias("b")).select(*keys, "b.*")


def with_faculty_uid(df: DataFrame, faculties: DataFrame) -> DataFrame:
    """The uid of a listed faculty, else the one made from the slug. ``faculties`` has slug and uid."""
    known = faculties.groupBy(F.col("slug").alias("faculty_slug")).agg(F.max("uid").alias("_known"))
    return df.join(known, "faculty_slug", "left").withColumn("resolved_faculty_uid", F.coalesce("_known", faculty_uid(F.col("faculty_slug")))).drop("_known")


def with_faculty_name(df: DataFrame, faculties: DataFrame) -> DataFrame:
    """The name of a listed faculty, else the slug in capitals. ``faculties`` has slug and name."""
    known = faculties.groupBy(F.col("slug").alias("faculty_slug")).agg(F.max("name").alias("_known"))
    return df.join(known, "faculty_slug", "left").withColumn("faculty_name", F.coalesce("_known", F.upper("faculty_slug"))).drop("_known")


def narrative(name: Column, level: Column, faculty: Column, budget: Column, tax: Column, source: Column, careers: Column) -> Column:
    """E8."""
    said = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(
        F.lit("Programul: "), name, F.lit(" ("), F.coalesce(level, F.lit("Master")), F.lit(")\nFacultate: "), F.upper(faculty), F.lit("\nLocuri Buget: "), said(budget), F.lit(" (Sursa: PDF "), source,
        F.lit(")\nLocuri Taxa: "), said(tax), F.lit(" (Sursa: PDF "), source, F.lit(")\n[INFERENCE]\nCariera: "), F.array_join(careers, ", "),
    )


def with_grade_line(text: Column, grade: Column, year: int) -> Column:
    """E9."""
    line = F.format_string(f"\nUltima Medie ({year - 1}): %.2f", grade)
    return F.when(grade.isNull(), text).otherwise(F.concat(F.coalesce(text, F.lit("")), line))


def programmes_from_papers(rows: DataFrame, programs: DataFrame) -> DataFrame:
    """Programmes of faculties that have none, one per faculty and name; the last paper wins (by pdf_rank, row_idx, address)."""
    lone = rows.join(programs.select("faculty_slug").where("faculty_slug IS NOT NULL").dropDuplicates(), "faculty_slug", "left_anti")
    order = F.struct(F.col("pdf_rank"), F.col("row_idx"), F.col("pdf_url"))
    last = lone.groupBy("faculty_slug", "program_name").agg(F.max_by(F.struct("spots_budget", "spots_tax", "level", "pdf_url"), order).alias("r"))
    key = F.concat("faculty_slug", F.lit("|"), "program_name")
    return last.select(
        uid(key).alias("uid"), program_id(F.col("faculty_slug"), F.col("program_name")).alias("program_id"), "faculty_slug", F.col("program_name").alias("name"),
        F.when(F.col("r.level").isNull(), "Unknown").otherwise(study_level(F.col("r.level"))).alias("level"), "r.spots_budget", "r.spots_tax", F.col("r.pdf_url").alias("source_url"), F.lit("pdf_only").alias("source_type"),
        likelihood(F.lit(1.0), F.lit(PDF_ONLY_PRIORITY)).alias("likelihood_score"),
    )
