"""Scans of entity files, exports, manifests, snapshots and configuration (SC1 to SC9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.session import list_path, read_text

_VALUE = "struct<source:string,source_name:string,value:struct<budget:int,tax:int>,score:double,match_score:double,likelihood_score:double,page:int,snippet:string,timestamp:string>"
PROGRAM = (
    "uid string, entity_type string, run_id string, scraped_at timestamp, source_url string, content_hash string, name string, level string, faculty_uid string, faculty_slug string, program_id string,"
    " duration_years string, language string, text_for_embedding string, spots_raw string, raw_admission_text string, admission_year int, spots_budget int, spots_tax int, source_type string, accuracy_confidence double,"
    f" last_admission_grade double, keywords array<string>, career_paths array<string>, evidence map<string,array<{_VALUE}>>,"
    " metadata struct<best_source_score:double,pdf_match_score:double,pdf_match_name:string,pdf_source:string,match_status:string,grade_source:string,original_pdf:string>"
)


def programs_json(spark: SparkSession, glob: str, keep_broken: bool = False, lines: bool = False) -> DataFrame:
    """SC1 to SC4: one JSON object per file, or (``lines``) one per line; broken ones are left out or kept with ``_corrupt``."""
    read = spark.read.schema(PROGRAM + ", _corrupt string").option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    df = read.json(glob).withColumn("file", F.input_file_name())
    return df if keep_broken else df.where("_corrupt IS NULL AND uid IS NOT NULL").drop("_corrupt")


def programs_of(spark: SparkSession, run_dir: str, faculty: str | None = None, layout: str = "{}/programs", lines: bool = False) -> DataFrame:
    """SC3, SC4: programmes of a run, or of one faculty of it. ``layout`` is the folder of a faculty under ``raw``."""
    return programs_json(spark, f"{run_dir}/raw/{layout.format(faculty or '*')}/*.json", lines=lines).where("entity_type = 'program'")


def exported_csv(spark: SparkSession, path: str) -> DataFrame:
    """SC5: an export with or without a byte-order mark, all columns as text; quoted values may hold line ends."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*(c.lstrip("\ufeff") for c in df.columns))


def run_faculties(spark: SparkSession, run_dir: str) -> DataFrame:
    """SC6: faculties of the manifest; without a manifest those that have files. On any file system."""
    if "manifest.json" in list_path(spark, run_dir):
        return spark.read.option("multiLine", True).schema("successful array<string>").json(f"{run_dir}/manifest.json").select(F.explode("successful").alias("faculty_slug"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{run_dir}/raw").select("path")
    return files.select(F.regexp_extract("path", r"/raw/(?:[^/=]+=)?([^/]+)/", 1).alias("faculty_slug")).where("faculty_slug <> ''").dropDuplicates()


def snapshots(spark: SparkSession, glob: str) -> DataFrame:
    """SC7: whole HTML files; the address stands in a comment on the first line."""
    df = spark.read.text(glob, wholetext=True).withColumn("file", F.input_file_name())
    return df.select(F.col("file").alias("page_id"), F.nullif(F.regexp_extract(F.split("value", "\n")[0], r"Source:\s*(\S+)", 1), F.lit("")).alias("url"), F.regexp_extract("file", r"/raw/([^/]+)/", 1).alias("faculty_slug"), F.col("value").alias("html"))


def latest_file(spark: SparkSession, glob: str) -> str | None:
    """SC8: the file changed last; of several at one time the one with the largest name."""
    row = spark.read.format("binaryFile").load(glob).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row.p if row else None


def config(spark: SparkSession, path: str) -> DataFrame:
    """SC9: (pos, slug, name, urls) of the configured faculties; none without the file."""
    import yaml

    text = read_text(spark, path)
    listed = (yaml.safe_load(text) or {}).get("faculties") or [] if text is not None else []
    return spark.createDataFrame([(i, f.get("slug"), f.get("name"), list(f.get("urls") or [])) for i, f in enumerate(listed)], "pos int, slug string, name string, urls array<string>")


def last_run(spark: SparkSession, manifests: DataFrame) -> DataFrame:
    """O11."""
    return manifests.agg(F.max("run_id").alias("run_id"))
