"""Row validation as Column structs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitta.functions.text import is_title, rule_form, tokens
from admitta.functions.vocab import COUNT_PATTERN, NEGATIVE, NOISE_PATTERN, POSITIVE, SUFFIXES

#: Points and thresholds of the name rule.
START, KEYWORD, SUFFIX, WORDS, TITLE, PASS, QUARANTINE = 20, 20, 15, 10, 10, 45, 30
LONGEST_NAME, SHORTEST_NAME, MOST_DIGITS = 150, 4, 0.4


def has_word_start(text: Column, starts: Sequence[str]) -> Column:
    """a word begins with one of the keywords. ``text`` is in rule form."""
    return text.rlike(r"(^|\s)(" + "|".join(map(re.escape, starts)) + ")")


def digit_share(norm: Column, raw: Column) -> Column:
    return F.length(F.regexp_replace(norm, r"[^0-9]", "")) / F.length(raw)


def distinct_letters(norm: Column) -> Column:
    """A10."""
    return F.size(F.array_distinct(F.filter(F.split(F.regexp_replace(norm, r"[^\p{L}]", ""), ""), lambda c: c != "")))


def _result(status: str, score: Column | float, reason: Column | str) -> Column:
    said = reason if isinstance(reason, Column) else F.lit(reason)
    points = score if isinstance(score, Column) else F.lit(score)
    return F.struct(F.lit(status).alias("status"), points.cast("int").alias("score"), said.alias("reason"))


def name_check(name: Column, negative: Sequence[str] = NEGATIVE, positive: Sequence[str] = POSITIVE, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """F1: struct(status, score, reason); the first rule that applies decides."""
    norm = rule_form(name)
    letters = F.regexp_replace(norm, r"[^\p{L}]", "")
    first_bad = F.coalesce(*(F.when(has_word_start(norm, [k]), F.lit(k)) for k in negative))
    points = (
        F.lit(START)
        + F.when(has_word_start(norm, positive), KEYWORD).otherwise(0)
        + F.when(norm.rlike("(" + "|".join(map(re.escape, suffixes)) + r")(\s|$)"), SUFFIX).otherwise(0)
        + F.when(F.size(tokens(norm)) >= 2, WORDS).otherwise(0)
        + F.when(is_title(name), TITLE).otherwise(0)
    )
    return (
        F.when(name.isNull() | (name == ""), _result("FAIL", 0, "Empty string"))
        .when(F.length(name) < SHORTEST_NAME, _result("FAIL", 0, "Too short"))
        .when(F.length(name) > LONGEST_NAME, _result("FAIL", 0, "Too long"))
        .when(digit_share(norm, name) > MOST_DIGITS, _result("FAIL", 10, "High digit ratio (looks like phone/CNP)"))
        .when((F.length(letters) >= 6) & (distinct_letters(norm) <= 2), _result("FAIL", 5, "Low character diversity"))
        .when(has_word_start(norm, negative), _result("FAIL", 0, F.concat(F.lit("Negative keyword: "), first_bad)))
        .when(points >= PASS, _result("PASS", points, "Good score"))
        .when(points >= QUARANTINE, _result("QUARANTINE", points, "Low confidence"))
        .otherwise(_result("FAIL", points, "Low score"))
    )


def _verdict(status: str, reason: str) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))


def hygiene_check(name: Column) -> Column:
    """noise of the page before counts inside the name."""
    return (
        F.when(name.isNull() | (name == ""), _verdict("FAIL", "Missing name"))
        .when(name.rlike(NOISE_PATTERN), _verdict("REVIEW", "Name contains UI noise"))
        .when(name.rlike(COUNT_PATTERN), _verdict("REVIEW", "Name contains embedded counts"))
        .otherwise(_verdict("PASS", "Clean name"))
    )


def spots_check(budget: Column, tax: Column, evidence: Column, source_type: Column, confidence: Column, least_match: float = 0.75, least_score: float = 20, least_confidence: float = 0.8) -> Column:
    """counts need an item of evidence of quality, or a parsed table of quality."""
    backed = F.exists(
        evidence,
        lambda e: (
            (F.coalesce(e["match_score"], F.lit(0.0)) >= least_match)
            & (F.coalesce(e["score"], F.lit(0.0)) >= least_score)
            & ((budget.isNotNull() & e["value"]["budget"].isNotNull()) | (tax.isNotNull() & e["value"]["tax"].isNotNull()))
        ),
    )
    by_table = (source_type == "html_table_parsed") & (confidence >= least_confidence)
    return (
        F.when(budget.isNull() & tax.isNull(), _verdict("PASS", "No numeric spots to validate"))
        .when(F.coalesce(backed, F.lit(False)) | F.coalesce(by_table, F.lit(False)), _verdict("PASS", "Verified spots"))
        .otherwise(_verdict("REJECT", "Spots unverified by high-quality evidence"))
    )


def identifier_check(program_id: Column, year: Column) -> Column:
    """F4."""
    return (
        F.when(program_id.isNull() | (program_id == ""), _verdict("REJECT", "Missing program_id"))
        .when(year.isNull() | (year == 0), _verdict("REJECT", "Missing admission_year"))
        .otherwise(_verdict("PASS", "Identifiers present"))
    )


def row_check(name: Column, program_id: Column, year: Column, budget: Column, tax: Column, evidence: Column, source_type: Column, confidence: Column) -> Column:
    """the checks in turn; missing identifiers only ask for a review."""
    named, clean = name_check(name), hygiene_check(name)
    ids, spots = identifier_check(program_id, year), spots_check(budget, tax, evidence, source_type, confidence)
    return (
        F.when(named["status"] == "FAIL", F.struct(named["status"].alias("status"), named["reason"].alias("reason")))
        .when(clean["status"].isin("FAIL", "REJECT"), clean)
        .when(ids["status"] == "REJECT", F.struct(F.lit("REVIEW").alias("status"), ids["reason"].alias("reason")))
        .when(spots["status"] == "REJECT", spots)
        .otherwise(_verdict("PASS", "All checks passed"))
    )


def split_by_name(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Passed, quarantined and failed rows, each with ``check``."""
    checked = df.withColumn("check", name_check(F.col(name)))
    return tuple(checked.where(F.col("check.status") == s) for s in ("PASS", "QUARANTINE", "FAIL"))


def publishable(confidence: Column, budget: Column, least: float = 0.4) -> Column:
    """low confidence without funded places is not published."""
    return ~((F.coalesce(confidence, F.lit(0.0)) < least) & (budget == 0))


def confidence_label(confidence: Column) -> Column:
    """F19."""
    return F.when(confidence > 0.8, "high").otherwise("medium")
