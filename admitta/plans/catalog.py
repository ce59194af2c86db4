"""All queries of the core, by name."""

from __future__ import annotations

from admitta.plans import io_queries, page_queries, pipeline_queries, snapshot_queries, text_queries

MODULES = (snapshot_queries, text_queries, pipeline_queries, page_queries, io_queries)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
