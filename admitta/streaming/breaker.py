"""Breakers over fetch outcomes (ST1, ST2) and the queue's states (ST4), on streams and on tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

OUT = "key string, at timestamp, failures int, open boolean"
STATE = "failures int, last_failure double, seen double"


def breaker_states(events: DataFrame, threshold: int = 3, reset_s: float = 300.0) -> DataFrame:
    """ST1 on a stream of (key, at, ok): after each outcome the failures in a row and whether the breaker is open.

    It opens after ``threshold`` failures in a row and closes on a success or ``reset_s`` after the
    last failure. Outcomes of a batch are taken in order of time; the state of a key that was quiet
    for twice that long is dropped.
    """

    def update(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        failures, last, seen = state.get if state.exists else (0, 0.0, 0.0)
        rows = pd.concat(list(batches)).sort_values(["at", "ok"], kind="stable")
        out = []
        for at, ok in zip(rows["at"], rows["ok"]):
            now = at.timestamp()
            if failures >= threshold and now - last > reset_s:
                failures = 0
            failures, last = (0, last) if ok else (failures + 1, now)
            seen = max(seen, now)
            out.append((key[0], at, failures, failures >= threshold))
        state.update((failures, last, seen))
        mark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(int((seen + 2 * reset_s) * 1000), mark + 1))
        yield pd.DataFrame(out, columns=["key", "at", "failures", "open"])

    return events.withWatermark("at", "10 minutes").groupBy("key").applyInPandasWithState(update, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def failures_in_a_row(events: DataFrame, key: str, order: list[str], ok: str, cell: Column) -> DataFrame:
    """ST2 on a table: failures since the last success of the key, without closing by time.

    ``cell`` cuts a key's events into stretches that follow each other in ``order``, such as hours:
    failures are counted inside a stretch, and what the stretches before it left open is carried over
    from one row per stretch. A key of any size hence spreads over many tasks.
    """
    cut = events.withColumn("_cell", cell).withColumn("_bad", F.when(F.col(ok), 0).otherwise(1))
    sofar = Window.partitionBy(key, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("_run", F.sum(1 - F.col("_bad")).over(sofar))
    ends = cut.groupBy(key, "_cell", "_run").agg(F.sum("_bad").alias("n")).groupBy(key, "_cell").agg(F.max("_run").alias("runs"), F.max_by("n", "_run").alias("open"))
    cells = Window.partitionBy(key).orderBy("_cell")
    upto = cells.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_since", F.sum((F.col("runs") > 0).cast("int")).over(upto))
    inner = Window.partitionBy(key, "_since").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = ends.withColumn("_left", F.sum("open").over(inner)).withColumn("_carried", F.coalesce(F.lag("_left").over(cells), F.lit(0)))
    carried = carried.select(F.col(key).alias("_k"), F.col("_cell").alias("_c"), "_carried")
    run = Window.partitionBy(key, "_cell", "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cut.withColumn("_inside", F.sum("_bad").over(run)).join(carried, F.col(key).eqNullSafe(F.col("_k")) & F.col("_cell").eqNullSafe(F.col("_c")))
    total = F.col("_inside") + F.when(F.col("_run") == 0, F.col("_carried")).otherwise(0)
    return counted.withColumn("failures", total).drop("_cell", "_bad", "_run", "_inside", "_carried", "_k", "_c")
