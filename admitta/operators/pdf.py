"""Programme rows out of page texts and tables of papers.

Input is (pdf_url, page_no, text, tables array<array<array<string>>>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.functions.parse import count_of, page_level
from admitta.functions.text import lower_ascii, unbroken
from admitta.functions.vocab import HEADER_WORDS, NAME_HEADERS, ROW_BLACKLIST
from admitta.operators.boilerplate import first_known
from admitta.operators.rank import contains_any

#: Fixed value: what a name is written with.
_NAME = r"[A-Za-zȘȚĂÂÎșțăâî\d\s\-(),./&]+?"
#: A labelled name with both counts; a name with both counts on one line; a labelled name alone.
LABELLED = rf"(?i)(?:Specializarea|Programul|Domeniul|DISCIPLINA)\s*[:\-]?\s*({_NAME})\s*[;|]?\s*(?=Locuri)[\s\S]{{0,300}}?Locuri\s*buget\s*[:\-]?\s*(\d+)[\s\S]{{0,100}}?Locuri\s*tax[aă]\s*[:\-]?\s*(\d+)"
LINE_ITEM = r"(?im)^([A-Za-zȘȚĂÂÎșțăâî\d \-(),./&]+?)[ \t]+(\d+)\s*loc[^\n]*?buget[^\n]*?(\d+)\s*loc[^\n]*?tax"
NAME_ONLY = r"(?im)(?:DISCIPLINA|SPECIALIZAREA|PROGRAMUL)\s*[:\-]\s*([A-ZȘȚĂÂÎ \-]+?)(?:\n|  |$)"


def blacklisted(name: Column) -> Column:
    """F9."""
    return contains_any(lower_ascii(name), ROW_BLACKLIST)


def _found(text: Column, pattern: str, rank: int, groups: int) -> Column:
    columns = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in range(1, groups + 1)]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.size(whole) - 1),
        lambda i: F.struct(
            F.lit(rank).alias("rank"), i.alias("pos"), F.trim(F.get(columns[0], i)).alias("name"),
            (F.get(columns[1], i).try_cast("int") if groups > 1 else F.lit(None).cast("int")).alias("budget"), (F.get(columns[2], i).try_cast("int") if groups > 2 else F.lit(None).cast("int")).alias("tax"),
            F.get(whole, i).alias("raw"),
        ),
    )


def text_rows(pages: DataFrame, source: str = "text", strict: bool = False) -> DataFrame:
    """Rows by three patterns, stronger ones first; a name is taken once per paper.

    Line items are looked for before lines are joined; ``strict`` looks for them after, as a page whose
    lines are lost would be read.
    """
    joined = F.regexp_replace(unbroken(F.col("text")), r"\s+", " ")
    level = page_level(joined)
    by_line = joined if strict else F.replace(F.col("text"), F.lit("-\n"), F.lit(""))
    some = lambda t, p, r, g: F.when(t.rlike(p), _found(t, p, r, g)).otherwise(F.array().cast("array<struct<rank:int,pos:int,name:string,budget:int,tax:int,raw:string>>"))
    every = F.concat(some(joined, LABELLED, 1, 3), some(by_line, LINE_ITEM, 2, 3), some(by_line, NAME_ONLY, 3, 1))
    rows = pages.where("text IS NOT NULL AND text <> ''").select("pdf_url", F.col("page_no").alias("page"), level.alias("level"), F.explode(every).alias("r")).select("pdf_url", "page", "level", "r.*")
    long = (F.col("rank") == 1) | (F.length("name") > 5)
    weak = (F.col("rank") == 3) & (F.contains(F.upper("name"), F.lit("MASTER")) | F.contains(F.upper("name"), F.lit("AGRONOMIE")))
    order = Window.partitionBy("pdf_url", "name").orderBy("page", "rank", "pos")
    kept = rows.where(long & ~weak).withColumn("n", F.row_number().over(order)).where("(rank = 1 OR n = 1)").where(~blacklisted(F.col("name")))
    level_known = F.lit("Unknown") if source == "ocr" else F.col("level")
    return kept.select("pdf_url", "page", F.col("name").alias("program_name"), F.col("budget").alias("spots_budget"), F.col("tax").alias("spots_tax"), level_known.alias("level"), F.substring("raw", 1, 100).alias("raw_row"), F.lit(source).alias("source"))


def table_rows(pages: DataFrame) -> DataFrame:
    """Rows of tables with a header row; the last matching column wins, then the third and sixth cell.

    The level comes from the first page that tells one (W3).
    """
    levelled = pages.withColumn("level", first_known(page_level(F.col("text")), ["pdf_url"], ["page_no"]))
    tables = levelled.select("pdf_url", "page_no", "level", F.posexplode("tables").alias("table_no", "t"))
    rows = tables.select("pdf_url", "page_no", "level", "table_no", F.posexplode("t").alias("row_no", "cells"))
    low = F.transform("cells", lambda c: F.trim(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" "))))
    rows = rows.withColumn("low", low).withColumn("header", contains_any(F.array_join("low", " "), HEADER_WORDS))
    key = ["pdf_url", "page_no", "table_no"]
    at = lambda test: F.array_max(F.filter(F.transform("low", lambda c, i: F.when(test(lower_ascii(c)), i)), lambda i: i.isNotNull()))
    places = F.struct(
        F.col("row_no").alias("header_no"), at(lambda c: contains_any(c, NAME_HEADERS)).alias("name"),
        at(lambda c: F.contains(c, F.lit("buget")) & ~F.contains(c, F.lit("tax"))).alias("budget"), at(lambda c: F.contains(c, F.lit("tax"))).alias("tax"),
    )
    headers = rows.where("header").groupBy(*key).agg(F.min(places).alias("h"))
    data = rows.join(headers, key).where("row_no > h.header_no")
    number = lambda i, default: F.coalesce(F.when(i.isNotNull(), count_of(F.get("cells", i))), count_of(F.get("cells", F.lit(default))))
    name = F.trim(F.get("cells", F.coalesce("h.name", F.lit(0))))
    out = data.select("pdf_url", F.col("page_no").alias("page"), "table_no", "row_no", name.alias("program_name"), number(F.col("h.budget"), 2).alias("spots_budget"), number(F.col("h.tax"), 5).alias("spots_tax"), "level", F.array_join("cells", " | ", "").alias("raw_row"))
    ok = (F.length("program_name") >= 3) & ~blacklisted(F.col("program_name")) & (F.col("spots_budget").isNotNull() | F.col("spots_tax").isNotNull() | (F.length("program_name") > 5))
    return out.where(ok).withColumn("source", F.lit("table"))


def rows_of_papers(pages: DataFrame, ocr_pages: DataFrame | None = None, least_ocr: int = 100) -> DataFrame:
    """Tables, else text, else the recognised text of papers with more than ``least_ocr`` letters."""
    cols = ["pdf_url", "page", "program_name", "spots_budget", "spots_tax", "level", "raw_row", "source"]
    tables = table_rows(pages).select(*cols)
    out = tables
    left = pages.join(tables.select("pdf_url").dropDuplicates(), "pdf_url", "left_anti")
    texts = text_rows(left).select(*cols)
    out = out.unionByName(texts)
    if ocr_pages is not None:
        done = out.select("pdf_url").dropDuplicates()
        long = ocr_pages.groupBy("pdf_url").agg(F.sum(F.length("text")).alias("n")).where(F.col("n") > least_ocr).select("pdf_url")
        out = out.unionByName(text_rows(ocr_pages.join(long, "pdf_url", "left_semi").join(done, "pdf_url", "left_anti"), "ocr").select(*cols))
    return out
