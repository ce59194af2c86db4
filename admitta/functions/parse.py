"""Numbers, levels, languages and names out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from admitta.functions.vocab import BOTH_PATTERN, BUDGET_PATTERN, COUNT_PATTERN, TAX_PATTERN


def count_of(c: Column) -> Column:
    """Digits before the first bracket as a whole number; null where there are none or too many."""
    return F.nullif(F.regexp_replace(F.regexp_extract(c.cast("string"), r"^([^(\[{]*)", 1), r"\D", ""), F.lit("")).try_cast("int")


def count_or_zero(c: Column) -> Column:
    """Number cut to a whole; 0 for anything else."""
    number = c.cast("string").try_cast("double")
    return F.coalesce(F.when(number.between(-2147483648, 2147483647), number).cast("int"), F.lit(0))


def grade(c: Column) -> Column:
    """A decimal with point or comma from 1 to 10, else null."""
    value = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(value.between(1.0, 10.0), value)


def _group(c: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, k), F.lit("")).try_cast("int")


def list_spots(c: Column) -> Column:
    """struct(budget, tax): both counts together, else each on its own."""
    both = c.rlike(BOTH_PATTERN)
    return F.struct(
        F.when(both, _group(c, BOTH_PATTERN, 1)).otherwise(_group(c, BUDGET_PATTERN, 1)).alias("budget"), F.when(both, _group(c, BOTH_PATTERN, 2)).otherwise(_group(c, TAX_PATTERN, 1)).alias("tax")
    )


def page_level(c: Column) -> Column:
    """Master before Licenta, from the words of a page; null where it has neither."""
    up = F.translate(F.upper(c), "ĂÂÎȘŞȚŢ", "AAISSTT")
    return F.when(F.contains(up, F.lit("MASTER")), "Master").when(F.contains(up, F.lit("LICENTA")), "Licenta")


def study_level(c: Column) -> Column:
    """P12."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return (
        F.when(F.contains(low, F.lit("master")), "Master")
        .when(F.contains(low, F.lit("licent")) | F.contains(low, F.lit("bachelor")), "Bachelor")
        .when(F.contains(low, F.lit("doctor")) | F.contains(low, F.lit("phd")), "PhD")
        .otherwise("Unknown")
    )


def url_level(url: Column) -> Column:
    """P13."""
    return F.when(F.contains(url, F.lit("licenta")), "Licenta").otherwise("Master")


def url_duration(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("licenta")), "4 ani").otherwise("2 ani")


def name_language(c: Column, codes: bool = False) -> Column:
    """Language of instruction by its mark in the name, as a word or (``codes``) as en, fr, ro."""
    low = F.lower(c)
    en, fr, ro = ("en", "fr", "ro") if codes else ("English", "French", "Romanian")
    return F.when(F.contains(low, F.lit("englez")) | F.contains(low, F.lit("english")), en).when(F.contains(low, F.lit("francez")), fr).otherwise(ro)


def item_name(c: Column) -> Column:
    """Name without a count after the first comma, and without anything after a semicolon."""
    parts = F.split(c, ",")
    second = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    head = F.when(second.rlike(r"\d") | F.contains(F.lower(second), F.lit("locuri")), F.trim(F.get(parts, F.lit(0)))).otherwise(c)
    return F.when(F.contains(head, F.lit(";")), F.trim(F.get(F.split(head, ";"), F.lit(0)))).otherwise(head)


def without_counts(c: Column) -> Column:
    """Counts inside names that speak of places are taken out, with the marks around them."""
    return F.when(F.contains(F.lower(c), F.lit("locuri")), F.trim(F.regexp_replace(c, COUNT_PATTERN, ""), F.lit(" -–—:,."))).otherwise(c)


def domain_label(c: Column) -> Column:
    """Text after the last "Domeniul", in this spelling only."""
    return F.trim(F.element_at(F.split(c, "Domeniul"), -1), F.lit(" :"))


def course_names(html: Column) -> Column:
    """Names of the courses in the page's JSON-LD blocks; blocks that are no JSON give none."""
    blocks = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    parsed = F.transform(blocks, lambda b: F.from_json(b, "hasCourse array<struct<name string>>")["hasCourse"])
    return F.filter(F.flatten(F.transform(parsed, lambda p: F.coalesce(F.transform(p, lambda x: x["name"]), F.array().cast("array<string>")))), lambda n: n.isNotNull() & (n != ""))
