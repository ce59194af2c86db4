"""Operators for preparing training data; nothing else in the library imports this package."""

from __future__ import annotations

import importlib

MODULES = ("entities", "lookalike", "canonical", "survivor", "packing", "mixing", "truncation")


def _modules():
    return [importlib.import_module(f"{__name__}.{m}") for m in MODULES]


def queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _modules() for k, s in m.SQL.items()}
