"""Lines repeated on many pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def page_lines(pages: DataFrame, group: str, page: str, text: str) -> DataFrame:
    """(group, page, pos, line) with blanks around lines removed; empty lines are left out."""
    split = pages.select(F.col(group).alias("g"), F.col(page).alias("p"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    return split.withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", "")).where("line <> ''")


def repeated_lines(lines: DataFrame, ratio: float = 0.6) -> DataFrame:
    """(g, line, pages, all_pages): lines on more than ``ratio`` of a group's pages, if it has more than one.

    Pairs of line and page are made distinct before they are counted, so a hot group spreads over tasks.
    """
    pages = lines.select("g", "p").dropDuplicates().groupBy("g").agg(F.count(F.lit(1)).alias("all_pages"))
    each = lines.select("g", "p", "line").dropDuplicates().groupBy("g", "line").agg(F.count(F.lit(1)).alias("pages"))
    return each.join(pages, "g").where((F.col("all_pages") > 1) & (F.col("pages") / F.col("all_pages") > ratio))


def without_repeated(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """(g, p, text): the pages put together again from the other lines, in their order."""
    rest = lines.join(repeated.select("g", "line"), ["g", "line"], "left_anti")
    return rest.groupBy("g", "p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))


def fill_forward(value: Column, group: list[str], order: list[str]) -> Column:
    """The last non-null value so far."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def first_known(value: Column, group: list[str], order: list[str]) -> Column:
    """The first non-null value so far."""
    return F.first(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
