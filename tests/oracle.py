"""Runs a query and its SQL over the same tables and compares rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        src = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{src}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "to_integral_value"):
        return round(float(value), 6)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(df, con, sql: str) -> list[str]:
    """What differs; an empty list when the rows are equal."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    theirs = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in cur.fetchall())
    ours = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    if ours == theirs:
        return []
    more, less = ours - theirs, theirs - ours
    return [f"{order}: {sum(ours.values())} rows against {sum(theirs.values())}; only ours {list(more.items())[:4]}; only theirs {list(less.items())[:4]}"]
