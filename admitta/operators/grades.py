"""Lowest grades of admitted candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admitta.functions.parse import grade
from admitta.operators.boilerplate import fill_forward
from admitta.operators.rank import contains_any

GRADE_HEADERS, NAME_HEADERS = ("medie", "nota", "concurs"), ("specializ", "program", "domeniu")


def table_grades(cells: DataFrame) -> DataFrame:
    """E23, W2 over (pdf_url, context, table_no, row_no, cells): (pdf_url, program_name, grade) rows.

    Columns come from the first row, the last match wins; tables without a grade column and rows too
    short for it are left out. A programme name of more than five letters holds for the rows after it.
    """
    key = ["pdf_url", "table_no"]
    at = lambda words: F.array_max(F.filter(F.transform("cells", lambda c, i: F.when(contains_any(F.lower(F.coalesce(c, F.lit(""))), words), i)), lambda i: i.isNotNull()))
    heads = cells.where("row_no = 0").select(*key, at(GRADE_HEADERS).alias("g"), at(NAME_HEADERS).alias("n")).where("g IS NOT NULL")
    rows = cells.where("row_no > 0").join(heads, key).where(F.size("cells") > F.col("g"))
    name = F.trim(F.get("cells", F.col("n")))
    rows = rows.withColumn("program_name", F.coalesce(fill_forward(F.when(F.length(name) > 5, name), key, ["row_no"]), F.col("context")))
    return rows.select("pdf_url", "program_name", grade(F.get("cells", F.col("g"))).alias("grade")).where("grade IS NOT NULL")


def lowest_grades(grades: DataFrame, keys: list[str], least: int = 3, low: float = 5.0, high: float = 10.0) -> DataFrame:
    """A1: per key with at least ``least`` grades of 1 to 10, the lowest passing one; none without a passing one."""
    ok = grades.where(F.col("grade").between(1.0, 10.0))
    agg = ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_grades"), F.min(F.when(F.col("grade").between(low, high), F.col("grade"))).alias("min_grade"))
    return agg.where((F.col("n_grades") >= least) & F.col("min_grade").isNotNull())


def merged_grades(grades: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of several papers the last one wins per key."""
    return grades.groupBy(*keys).agg(F.max_by("min_grade", order).alias("min_grade"))
