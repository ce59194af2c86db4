"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``{folder}/{name}.parquet``; zone-less timestamps become UTC timestamps."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not zoneless:
        return df
    return df.select(*(F.col(f"`{c}`").cast("timestamp").alias(c) if c in zoneless else F.col(f"`{c}`") for c in df.columns))
