"""Ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def salted_rank(df: DataFrame, group: Sequence[str], cell: Sequence[str], order: Sequence[str], name: str = "rank0") -> DataFrame:
    """Add the 0-based rank of each row inside its group.

    ``cell`` columns split a group into ordered cells, one column after the other: rows are numbered
    inside their cell, and the rows of all earlier cells are added level by level, from the counts per
    value of one cell column under the same values of those before. No task holds more than one cell
    of rows, or the values of one level under one parent. Rows equal in all ``order`` columns get
    distinct ranks.
    """
    keys = [*group, *cell]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_before", F.lit(0))
    for level in range(len(cell), 0, -1):
        above = [*group, *cell[: level - 1]]
        before = Window.partitionBy(*above).orderBy(cell[level - 1]).rowsBetween(Window.unboundedPreceding, -1)
        if level == len(cell):
            offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            continue
        sums = counts.groupBy(*above, cell[level - 1]).agg(F.sum("_n").alias("_n")).withColumn("_up", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        renamed = sums.select(*(F.col(k).alias(f"_o_{k}") for k in (*above, cell[level - 1])), "_up")
        same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in (*above, cell[level - 1])]
        offsets = offsets.join(renamed, same).withColumn("_before", F.col("_before") + F.col("_up")).select(*keys, "_before")
    renamed = offsets.select(*(F.col(k).alias(f"_o_{k}") for k in keys), "_before")
    inside = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    joined = inside.join(renamed, same, "left")
    return joined.withColumn(name, (F.col("_before") + F.col("_pos")).cast("long")).drop("_pos", "_before", *(f"_o_{k}" for k in keys))
