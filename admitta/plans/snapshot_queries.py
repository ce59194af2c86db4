"""Queries on consecutive full snapshots (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.operators.snapshots import COMPARED, changed_values, diff_snapshots
from admitta.sources.tables import table


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return diff_snapshots(table(spark, folder, "program_snapshots"), table(spark, folder, "run_manifests")).select("run_id", "uid", "change_kind")


def p5_changed_values(spark: SparkSession, folder: str) -> DataFrame:
    snapshots, manifests = table(spark, folder, "program_snapshots"), table(spark, folder, "run_manifests")
    out = changed_values(diff_snapshots(snapshots, manifests), snapshots)
    cols = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in COMPARED]
    return out.select("run_id", "uid", *cols)


_PREPARED = """
runs AS (
  SELECT run_id, row_number() OVER (ORDER BY min(started_at), run_id) - 1 AS ord
  FROM run_manifests WHERE lower(trim(status)) = 'success' AND run_id IS NOT NULL GROUP BY run_id),
cleaned AS (
  SELECT nullif(lower(regexp_replace(uid, '\\s+', '', 'g')), '') AS uid, s.run_id, r.ord, scraped_at,
         nullif(regexp_replace(lower(regexp_replace(content_hash, '\\s+', '', 'g')), '^sha-?256:', ''), '') AS digest,
         name, level, duration_years, admission_year, spots_budget, spots_tax
  FROM program_snapshots s JOIN runs r ON s.run_id = r.run_id),
latest AS (
  SELECT * FROM cleaned WHERE uid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY uid, ord ORDER BY scraped_at DESC NULLS LAST, digest, name) = 1),
compared AS (
  SELECT n.uid AS new_uid, o.uid AS old_uid, coalesce(n.uid, o.uid) AS uid, coalesce(n.ord, o.ord + 1) AS ord,
         CASE WHEN o.uid IS NULL THEN 'added' WHEN n.uid IS NULL THEN 'removed'
              WHEN CASE WHEN n.digest IS NOT NULL AND o.digest IS NOT NULL THEN n.digest <> o.digest
                   ELSE (n.name, n.level, n.duration_years, n.admission_year, n.spots_budget, n.spots_tax)
                        IS DISTINCT FROM (o.name, o.level, o.duration_years, o.admission_year, o.spots_budget, o.spots_tax) END
              THEN 'changed' END AS change_kind,
         o.name AS old_name, o.level AS old_level, o.duration_years AS old_duration_years, o.admission_year AS old_admission_year,
         o.spots_budget AS old_spots_budget, o.spots_tax AS old_spots_tax,
         n.name AS new_name, n.level AS new_level, n.duration_years AS new_duration_years, n.admission_year AS new_admission_year,
         n.spots_budget AS new_spots_budget, n.spots_tax AS new_spots_tax
  FROM latest n FULL OUTER JOIN latest o ON n.uid = o.uid AND n.ord = o.ord + 1)"""

_LAST = "(SELECT max(ord) FROM runs)"

SQL = {
    "p5_found": f"""WITH {_PREPARED}
SELECT r.run_id, c.uid, c.change_kind FROM compared c JOIN runs r ON r.ord = c.ord
WHERE c.change_kind IS NOT NULL AND c.ord BETWEEN 1 AND {_LAST}""",
    "p5_changed_values": f"""WITH {_PREPARED}
SELECT r.run_id, c.uid, c.old_name, c.old_level, c.old_duration_years, c.old_admission_year, c.old_spots_budget, c.old_spots_tax,
       c.new_name, c.new_level, c.new_duration_years, c.new_admission_year, c.new_spots_budget, c.new_spots_tax
FROM compared c JOIN runs r ON r.ord = c.ord WHERE c.change_kind = 'changed' AND c.ord BETWEEN 1 AND {_LAST}""",
}

QUERIES = {"p5_found": p5_found, "p5_changed_values": p5_changed_values}
