"""A catalog query dict compiled to a filter column, text clauses and sort keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from findlark.config import Settings
from findlark.operators.predicates import predicate
from findlark.operators.textmatch import Clause, text_clauses
from findlark.registry import Registry

# Paging keys a query may carry, and the spellings of a descending order.
PAGING_KEYS = ("b_size", "b_start", "sort_limit")
DESCENDING = ("descending", "reverse", "desc")


@dataclass(frozen=True)
class CompiledQuery:
    where: Column | None
    clauses: tuple[Clause, ...]
    sort: tuple[tuple[str, bool], ...]
    has_text: bool

    @property
    def match_all(self) -> bool:
        return self.where is None and not self.has_text


Assembler = Callable[[Mapping[str, Any], Registry, T.StructType, Settings], CompiledQuery]


def sort_keys(query: Mapping[str, Any]) -> tuple[tuple[str, bool], ...]:
    """``(name, descending)`` per comma-separated sort field; one direction for all."""
    descending = query.get("sort_order", "asc") in DESCENDING
    fields = query.get("sort_on") or ""
    return tuple((name.strip(), descending) for name in fields.split(",") if name.strip())


def normalise(query: Mapping[str, Any]) -> dict[str, Any]:
    """The constraints of a query: sort and paging keys removed."""
    extra = {"sort_on", "sort_order", *PAGING_KEYS}
    return {key: value for key, value in query.items() if key not in extra}


def compile_query(
    query: Mapping[str, Any], registry: Registry, schema: T.StructType, settings: Settings
) -> CompiledQuery:
    """Filters are joined by *and* and do not score; text clauses of all keys are joined by *or*.

    Unknown keys are ignored, values without meaning set no constraint, and a search-only
    name that is not registered is searched as text.
    """
    filters: list[Column] = []
    clauses: list[Clause] = []
    has_text = False
    for key, value in normalise(query).items():
        spec = registry.get(key)
        if spec is None and key not in settings.search_only:
            continue
        if spec is None or spec.is_text:
            text = value["query"] if isinstance(value, Mapping) and "query" in value else value
            clauses += text_clauses(key, text)
            has_text = True
            continue
        constraint = predicate(spec, value, schema, settings)
        if constraint is not None:
            filters.append(constraint)
    where = reduce(and_, filters) if filters else None
    return CompiledQuery(where, tuple(clauses), sort_keys(query), has_text)
