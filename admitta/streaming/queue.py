"""The queue of papers as a table that a stream of downloads is merged into (ST4).

The queue stands in numbered versions in one folder. A micro-batch writes the next version from the
last one and its results, and then drops older ones; a batch that is run again after a break finds its
version written and does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from admitta.operators.coverage import write_back
from admitta.session import delete_path, list_path


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions, smallest first."""
    return sorted(int(n[2:]) for n in list_path(spark, path) if n.startswith("v=") and "_SUCCESS" in list_path(spark, f"{path}/{n}"))


def start(spark: SparkSession, queue: DataFrame, path: str) -> None:
    """The queue before the first batch."""
    queue.write.mode("overwrite").parquet(f"{path}/v=0")


def current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/v={_versions(spark, path)[-1]}")


def merged(results: DataFrame, path: str) -> DataStreamWriter:
    """A writer of results (address, seq, status, local_path) into the queue; later batches win, within one the largest seq."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        there = _versions(spark, path)
        if number + 1 in there:
            return
        last = max(v for v in there if v <= number)
        write_back(spark.read.parquet(f"{path}/v={last}"), batch).drop("address").write.mode("overwrite").parquet(f"{path}/v={number + 1}")
        for old in there:
            delete_path(spark, f"{path}/v={old}")

    return results.writeStream.foreachBatch(merge)
