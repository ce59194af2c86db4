"""Mixing sources to target shares (problem 7).

The shares fix one number of expected copies per source. Inside a source the documents are ordered
by size, their expected copies are summed up along that order, one random offset is added, and a
document comes out once for every whole number its stretch crosses. Ordering by size keeps the
sampled tokens close to the share; the stretch of a document bounds its copies by the cap. Of a fixed
number of random offsets each source takes the one that brings its tokens closest to its share, which
matters where a share is worth few documents; what an offset gives is read off the histogram of sizes.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.llm.tokens import VOCABULARY, sized_documents
from admitta.operators.ranking import salted_rank
from admitta.session import materialize
from admitta.sources.tables import table

SEED = 20260101
CELL_ROWS = 200_000
#: Random offsets tried per source.
OFFSETS = 64


@dataclass
class Mix:
    sized: DataFrame
    targets: list[tuple[str, float, int]]
    available: dict[str, tuple[int, int]]
    copies: dict[str, float]


def target_list(targets: DataFrame) -> list[tuple[str, float, int]]:
    """(source, share of one, cap). Shares are scaled to the sum 1; rows without source, positive share or cap are left out.

    A parameter table, refused beyond 10,000 rows; of a source listed twice the largest share counts.
    """
    ok = targets.where(F.col("source").isNotNull() & (F.col("target_share") > 0) & ~F.isnan("target_share") & (F.col("max_repeats") > 0))
    rows = ok.groupBy("source").agg(F.max("target_share").alias("t"), F.max("max_repeats").alias("m")).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 sources")
    total = sum(r.t for r in rows)
    return sorted((r.source, r.t / total, r.m) for r in rows)


def plan_mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, vocabulary: str = VOCABULARY) -> Mix:
    """Expected copies per source for the largest total that all caps allow, or for ``total_tokens``.

    A source without tokens gives nothing, and the others keep their relation. With a larger
    ``total_tokens`` a source stops at its cap and falls short, which the report shows.
    """
    listed = target_list(targets)
    docs = documents.where(F.col("source").isin([s for s, _, _ in listed]))
    sized = materialize(sized_documents(docs, ["doc_id", "source"], vocabulary))
    got = {r[0]: (r[1], r[2]) for r in sized.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens"), F.count(F.lit(1))).collect()}  # one row per listed source
    able = [(s, t, m) for s, t, m in listed if s in got]
    most = min((got[s][0] * m / t for s, t, m in able), default=0.0)
    total = float(total_tokens) if total_tokens is not None else most
    copies = {s: min(float(m), total * t / got[s][0]) for s, t, m in able}
    return Mix(sized, listed, got, copies)


def _rates(mix: Mix, more: list[tuple], columns: str) -> DataFrame:
    """One row per listed source (a parameter table), small enough for every task."""
    return F.broadcast(mix.sized.sparkSession.createDataFrame(more, columns))


def offsets(mix: Mix, seed: int = SEED) -> dict[str, float]:
    """Per source the random offset whose tokens come closest to the expected ones; the first one wins ties.

    Documents of one size stand together in the order, so the copies of all of them follow from their
    first and last rank.
    """
    tried = [(s, e, [random.Random(f"{seed}|{s}|{k}").random() for k in range(OFFSETS)]) for s, e in sorted(mix.copies.items())]
    if not tried:
        return {}
    sizes = mix.sized.where("n_tokens > 0").groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stretches = sizes.withColumn("last", upto).join(_rates(mix, tried, "source string, e double, us array<double>"), "source")
    each = stretches.select("source", "n_tokens", "n", "last", "e", F.posexplode("us").alias("k", "u"))
    copies = F.floor(F.col("e") * F.col("last") + F.col("u")) - F.floor(F.col("e") * (F.col("last") - F.col("n")) + F.col("u"))
    got = each.groupBy("source", "k").agg(F.sum(F.col("n_tokens") * copies).alias("tokens")).collect()  # OFFSETS rows per listed source
    best: dict[str, tuple[float, int]] = {}
    for r in got:
        miss = abs(r.tokens - mix.copies[r.source] * mix.available[r.source][0])
        best[r.source] = min(best.get(r.source, (float("inf"), 0)), (miss, r.k))
    return {s: us[best[s][1]] for s, _, us in tried if s in best}


def draw(mix: Mix, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, use_count) of the documents used; those of no tokens never are."""
    caps = {s: m for s, _, m in mix.targets}
    rates = [(s, mix.copies[s], u, caps[s]) for s, u in sorted(offsets(mix, seed).items())]
    cells = max(1, sum(n for _, n in mix.available.values()) // CELL_ROWS + 1)
    some = mix.sized.where("n_tokens > 0").withColumn("_cell", F.pmod(F.xxhash64("doc_id"), F.lit(cells)))
    ranked = salted_rank(some, ["source"], ["n_tokens", "_cell"], ["doc_id"]).join(_rates(mix, rates, "source string, _e double, _u double, _cap int"), "source")
    crossed = F.floor(F.col("_e") * (F.col("rank0") + 1) + F.col("_u")) - F.floor(F.col("_e") * F.col("rank0") + F.col("_u"))
    used = ranked.withColumn("use_count", F.least(crossed, F.col("_cap").cast("long")).cast("int"))
    return used.where("use_count > 0").select("doc_id", "source", "n_tokens", "use_count")


def shares(mix: Mix, seed: int = SEED) -> DataFrame:
    """Per listed source: target and actual share and their difference, tokens there, wanted and used, documents used, most uses of one."""
    spark = mix.sized.sparkSession
    rows = [(s, t, m, mix.available.get(s, (0, 0))[0], mix.copies.get(s, 0.0)) for s, t, m in mix.targets]
    base = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, tokens_available long, expected_copies double")
    used = draw(mix, seed).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("use_count")).alias("tokens_used"), F.count(F.lit(1)).alias("documents_used"), F.max("use_count").alias("most_uses"))
    both = base.join(used, "source", "left").fillna({"tokens_used": 0, "documents_used": 0, "most_uses": 0})
    both = both.withColumn("_total", F.sum("tokens_used").over(Window.partitionBy()))  # one row per listed source
    share = F.when(F.col("_total") > 0, F.col("tokens_used") / F.col("_total")).otherwise(0.0)
    wanted = (F.col("expected_copies") * F.col("tokens_available")).alias("tokens_wanted")
    return both.select("source", "target_share", share.alias("actual_share"), (share - F.col("target_share")).alias("share_error"), "max_repeats", "expected_copies", "tokens_available", wanted, "tokens_used", "documents_used", "most_uses")


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    return draw(plan_mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")))


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return shares(plan_mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")))


QUERIES = {"p7_mix": p7_mix, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
