"""Coverage of a list that is held true (J8, J9, A6), run summaries (A7, A11, A12, W7), changes of the queue (J10, SK11, ST4, E21, O5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.functions.text import truth_form

#: Length of the pieces that the containment join looks up.
GRAM = 6


def exact_hits(truth: DataFrame, output: DataFrame) -> DataFrame:
    """Truth rows (key, name) with ``found``, by their form."""
    forms = output.select(truth_form(F.col("name")).alias("form")).where("form IS NOT NULL").dropDuplicates().withColumn("found", F.lit(True))
    return truth.withColumn("form", truth_form(F.col("name"))).join(forms, "form", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def containment_hits(truth: DataFrame, output: DataFrame) -> DataFrame:
    """(key) of truth rows whose form holds, or is held by, a form of the output.

    A form that is inside another shares all its pieces of ``GRAM`` letters with it, so it is looked up
    by the one that the fewest forms of the other side have; no piece of many forms is joined unless a
    form has nothing else. Shorter forms are whole pieces of their own length.
    """
    left = truth.select(F.col("key"), truth_form(F.col("name")).alias("form")).where("form <> ''")
    right = output.select(truth_form(F.col("name")).alias("form")).where("form <> ''").dropDuplicates()
    out = _inside(left.select("form").dropDuplicates(), right).select(F.col("inner").alias("form"))
    out = out.unionByName(_inside(right, left.select("form").dropDuplicates()).select(F.col("outer").alias("form"))).dropDuplicates()
    return left.join(out, "form", "left_semi").select("key").dropDuplicates()


def _pieces(form: Column, size: int) -> Column:
    return F.when(F.length(form) >= size, F.transform(F.sequence(F.lit(1), F.length(form) - size + 1), lambda i: F.substring(form, i, size))).otherwise(F.array().cast("array<string>"))


def _inside(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """(inner, outer): pairs of distinct forms of which the first is part of the second."""
    sizes = sorted(r[0] for r in inner.select(F.least(F.length("form"), F.lit(GRAM))).distinct().collect())  # at most GRAM numbers
    if not sizes:
        sizes = [GRAM]
    cut = outer.select(F.col("form").alias("outer"), F.explode(F.array_distinct(F.concat(*(_pieces(F.col("form"), n) for n in sizes)))).alias("piece"))
    often = cut.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    own = F.coalesce(*(F.when(F.least(F.length("form"), F.lit(GRAM)) == n, _pieces(F.col("form"), n)) for n in sizes))
    heads = inner.select(F.col("form").alias("inner"), F.explode(F.array_distinct(own)).alias("piece")).join(often, "piece")
    heads = heads.groupBy("inner").agg(F.min(F.struct("n", "piece"))["piece"].alias("piece"))
    return heads.join(cut, "piece").where(F.contains("outer", F.col("inner"))).select("inner", "outer").dropDuplicates()


def coverage(hits: DataFrame, group: str) -> DataFrame:
    """Rows, found ones and percentage per group, and over all (group null)."""
    counts = hits.rollup(group).agg(F.count(F.lit(1)).alias("total"), F.count_if("found").alias("found"))
    return counts.withColumn("percentage", F.round(100.0 * F.col("found") / F.col("total"), 4))


def run_summary(outcomes: DataFrame, ok: Column) -> DataFrame:
    """A7."""
    return outcomes.agg(F.count(F.lit(1)).alias("urls"), F.count_if(ok).alias("success"), (F.count(F.lit(1)) - F.count_if(ok)).alias("failed"))


def first_seen(queue: DataFrame) -> DataFrame:
    """One entry per address, the first in input order; entries without an address are left out."""
    address = F.coalesce("pdf_url", "url")
    order = Window.partitionBy("address").orderBy("input_pos", "faculty_slug", F.col("discovered_at").asc_nulls_last(), F.col("status").asc_nulls_last(), F.col("link_text").asc_nulls_last())
    return queue.withColumn("address", address).where("address IS NOT NULL").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def write_back(queue: DataFrame, results: DataFrame) -> DataFrame:
    """SK11, ST4: new status and path where a download has a result for the address, else the old ones."""
    new = results.groupBy("address").agg(F.max(F.struct("seq", "status", "local_path")).alias("r"))
    joined = queue.withColumn("address", F.coalesce("pdf_url", "url")).join(new, "address", "left")
    return joined.withColumn("status", F.coalesce("r.status", "status")).withColumn("local_path", F.coalesce("r.local_path", "local_path")).drop("r")


def domain_group(url: Column, groups: Mapping[str, Sequence[str]], longest: bool = True) -> Column:
    """The group of the longest domain in the address, or (not ``longest``) of the first in order; ``default`` without any."""
    pairs = [(d, g) for g, ds in groups.items() for d in ds]
    if longest:
        pairs.sort(key=lambda p: -len(p[0]))
    out = F.lit(None).cast("string")
    for d, g in reversed(pairs):
        out = F.when(F.contains(url, F.lit(d)), g).otherwise(out)
    return F.coalesce(out, F.lit("default"))


def first_listed(df: DataFrame, order: str, limit: int | None) -> DataFrame:
    """The first entries of a list, for a trial run; all of them without a limit."""
    return df if limit is None else df.orderBy(order).limit(limit)


def counts(records: DataFrame, file: str = "file") -> DataFrame:
    """Files read and records found, for the message of a run."""
    return records.agg(F.count_distinct(file).alias("files"), F.count(F.lit(1)).alias("records"))


def progress(df: DataFrame, order: str) -> DataFrame:
    """``[i/n]`` over a list of bounded size, such as the configured faculties."""
    one = Window.partitionBy()
    place = F.row_number().over(one.orderBy(order))
    return df.withColumn("progress", F.concat(F.lit("["), place.cast("string"), F.lit("/"), F.count(F.lit(1)).over(one).cast("string"), F.lit("]")))
