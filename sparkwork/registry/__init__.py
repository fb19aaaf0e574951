"""All registered queries (Spark) and their DuckDB oracle SQL, keyed alike."""

from __future__ import annotations

import importlib

_AREAS = ("text", "aggregates", "factorise", "linear", "vectors", "sources")


def _modules():
    return [importlib.import_module(f"{__name__}.{name}") for name in _AREAS]


def queries() -> dict:
    out: dict = {}
    for mod in _modules():
        out.update(mod.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for mod in _modules():
        out.update(getattr(mod, "ORACLE", {}))
    return out
