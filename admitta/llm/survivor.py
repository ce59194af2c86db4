"""Best representative of each duplicate group (problem 4).

Records of a group are ranked with window ordering: a usable value first, then trust, recency,
completeness and, last, the values themselves, so the order is total. Only the first row of a group
is kept, which Spark turns into a top-1 per map task ahead of the shuffle; a group of any size hence
reaches one task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.sources.tables import table

#: The usual trust in each way of extraction.
SOURCE_TRUST = {"jsonld": 0.95, "html_table_parsed": 0.85, "html_text_parsed": 0.8, "pdf_only": 0.7, "html": 0.55, "html_list_mixed": 0.5}
#: A count of places outside this range is no count.
USABLE = (0, 300)

FIELDS = ("spots_budget", "spots_tax")
COMPLETENESS = ("name", "level", "duration_years", "language", "spots_raw", "raw_admission_text", "admission_year", "spots_budget", "spots_tax", "last_admission_grade", "domain")


def source_key(col: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(col)), r"[-\s]+", "_")


def trust(confidence: Column, source_type: Column) -> Column:
    """Confidence as a fraction of one; the usual trust of the source where it is null.

    Numbers above 1 are percentages; NaN, negative numbers and numbers above 100 count as null;
    an unknown source has trust 0.
    """
    given = F.when(F.isnan(confidence) | (confidence < 0) | (confidence > 100), None).when(confidence > 1, confidence / 100).otherwise(confidence)
    usual = F.lit(None).cast("double")
    for name, value in SOURCE_TRUST.items():
        usual = F.when(source_key(source_type) == name, F.lit(value)).otherwise(usual)
    return F.coalesce(given, usual, F.lit(0.0))


def completeness(names: Sequence[str]) -> Column:
    return sum((F.col(f"`{n}`").isNotNull().cast("int") for n in names), F.lit(0))


def _prepared(programs: DataFrame) -> DataFrame:
    return programs.select(
        F.col("program_id").alias("program_id"),
        F.col("uid").alias("uid"),
        trust(F.col("accuracy_confidence"), F.col("source_type")).alias("trust"),
        F.col("scraped_at").cast("timestamp").alias("seen_at"),
        completeness(COMPLETENESS).alias("filled"),
        *(F.col(f).alias(f) for f in FIELDS),
    ).where(F.col("program_id").isNotNull() & F.col("uid").isNotNull())


def _ranking() -> list[Column]:
    return [F.desc("trust"), F.desc_nulls_last("seen_at"), F.desc("filled"), F.asc("uid")]


def groups_of_many(records: DataFrame) -> DataFrame:
    """program_ids with two or more distinct uids, from two extremes per group."""
    return records.groupBy("program_id").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo <> hi").select("program_id")


def surviving_fields(programs: DataFrame) -> DataFrame:
    """(program_id, field_name, uid, value): the record whose value survives, per field.

    Groups of one uid, rows without program_id or uid, and fields without a usable value give no
    row. Rows delivered twice change nothing.
    """
    records = _prepared(programs)
    values = records.select(
        "program_id", "uid", "trust", "seen_at", "filled", F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS))).alias("x")
    ).select("program_id", "uid", "trust", "seen_at", "filled", "x.field_name", "x.value")
    usable = values.where(F.col("value").between(*USABLE))
    order = Window.partitionBy("program_id", "field_name").orderBy(*_ranking(), F.asc("value"))
    best = usable.withColumn("place", F.row_number().over(order)).where("place = 1")
    return best.join(groups_of_many(records), "program_id", "left_semi").select("program_id", "field_name", "uid", "value")


def surviving_records(programs: DataFrame) -> DataFrame:
    """One record per non-null program_id, built field by field.

    The top-ranked record gives uid, trust and completeness; each count comes from the best record
    that has a usable one, with the uid it came from, and is null where no record has any.
    """
    records = _prepared(programs)
    order = Window.partitionBy("program_id").orderBy(*_ranking(), *(F.asc_nulls_last(f) for f in FIELDS))
    top = records.withColumn("place", F.row_number().over(order)).where("place = 1").select("program_id", "uid", "trust", "filled")
    for f in FIELDS:
        own = Window.partitionBy("program_id").orderBy(*_ranking(), F.asc(f))
        best = records.where(F.col(f).between(*USABLE)).withColumn("place", F.row_number().over(own)).where("place = 1")
        top = top.join(best.select("program_id", F.col(f), F.col("uid").alias(f"{f}_uid")), "program_id", "left")
    return top


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return surviving_fields(table(spark, folder, "programs")).select("program_id", "field_name", "uid")


def p4_golden(spark: SparkSession, folder: str) -> DataFrame:
    return surviving_records(table(spark, folder, "programs"))


_SOURCE = "regexp_replace(lower(trim(source_type)), '[-\\s]+', '_', 'g')"
_TRUST = (
    "coalesce(CASE WHEN isnan(accuracy_confidence) OR accuracy_confidence < 0 OR accuracy_confidence > 100 THEN NULL"
    " WHEN accuracy_confidence > 1 THEN accuracy_confidence / 100 ELSE accuracy_confidence END, CASE "
    + " ".join(f"WHEN {_SOURCE} = '{k}' THEN {v}::double" for k, v in SOURCE_TRUST.items())
    + " END, 0.0::double)"
)
_FILLED = " + ".join(f"({c} IS NOT NULL)::int" for c in COMPLETENESS)
_BASE = f"""
r AS (SELECT program_id, uid, {_TRUST} AS trust, scraped_at AS seen_at, {_FILLED} AS filled, spots_budget, spots_tax
      FROM programs WHERE program_id IS NOT NULL AND uid IS NOT NULL)"""
_ORDER = "trust DESC, seen_at DESC NULLS LAST, filled DESC, uid"


def _best(field: str) -> str:
    return f"""SELECT program_id, '{field}' AS field_name, uid, {field} AS value FROM r WHERE {field} BETWEEN {USABLE[0]} AND {USABLE[1]}
QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY {_ORDER}, {field}) = 1"""


SQL = {
    "p4_found": f"""WITH {_BASE}, best AS ({_best("spots_budget")} UNION ALL {_best("spots_tax")})
SELECT program_id, field_name, uid FROM best
WHERE program_id IN (SELECT program_id FROM r GROUP BY program_id HAVING count(DISTINCT uid) > 1)""",
    "p4_golden": f"""WITH {_BASE}, b AS ({_best("spots_budget")}), t AS ({_best("spots_tax")}),
top AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY {_ORDER}, spots_budget, spots_tax) = 1)
SELECT top.program_id, top.uid, top.trust, top.filled, b.value AS spots_budget, b.uid AS spots_budget_uid, t.value AS spots_tax, t.uid AS spots_tax_uid
FROM top LEFT JOIN b ON b.program_id = top.program_id LEFT JOIN t ON t.program_id = top.program_id""",
}

QUERIES = {"p4_found": p4_found, "p4_golden": p4_golden}
