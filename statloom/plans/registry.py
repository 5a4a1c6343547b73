"""All queries of the core package."""

from __future__ import annotations

from statloom.plans import data_queries, reference_queries

_MODULES = [reference_queries, data_queries]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
