"""Registered queries over the driver tables, each with SQL that gives the same rows."""

from __future__ import annotations

from findlark.workload import content, corpus, filters, lifecycle, results, text, upkeep

MODULES = (filters, text, results, upkeep, content, corpus, lifecycle)


def all_queries() -> dict:
    return {name: entry for module in MODULES for name, entry in module.QUERIES.items()}
