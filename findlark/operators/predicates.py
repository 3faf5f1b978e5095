"""Query values compiled to filter columns. ``None`` means the value sets no constraint."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import UTC, datetime
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.config import Settings
from findlark.functions.text import tokens
from findlark.functions.values import first_of, instant_literal
from findlark.registry import IndexSpec

LISTS = (list, tuple, set, frozenset)


def predicate(
    spec: IndexSpec, value: Any, schema: T.StructType, settings: Settings | None = None
) -> Column | None:
    """The constraint ``value`` puts on the index ``spec``, or ``None``."""
    settings = settings or Settings()
    if spec.kind in ("date", "recurring"):
        return _date(spec.name, value, schema)
    if spec.kind == "daterange":
        return _interval(spec.name, value, schema)
    if spec.kind == "path":
        return _path(spec.name, value, settings.strict_subtree)
    return _exact(spec, value, settings)


def allowed_for(column: str, principals: Iterable[str]) -> Column:
    """Rows whose allowed principals overlap the viewer's."""
    allowed = F.array(*[F.lit(p) for p in sorted(principals)]).cast("array<string>")
    return F.arrays_overlap(F.col(column), allowed)


def in_effect(column: str, schema: T.StructType, now: datetime | None = None) -> Column:
    """Rows whose interval contains ``now``, which is fixed once per query."""
    return _interval(column, now or datetime.now(UTC), schema)


def _unwrap(value: Any) -> tuple[Any, Mapping[str, Any]]:
    if isinstance(value, Mapping) and "query" in value:
        return value["query"], value
    return value, {}


def _exact(spec: IndexSpec, value: Any, settings: Settings) -> Column | None:
    value, options = _unwrap(value)
    if value is None or (isinstance(value, str) and value == ""):
        return None
    if isinstance(value, LISTS):
        values = [item for item in value if item is not None]
        if not value:
            return None
        if settings.honour_operator and options.get("operator") == "and":
            return reduce(and_, [_has(spec, [item]) for item in values])
        return _has(spec, values)
    if isinstance(value, Mapping) and "not" in value:
        unwanted = value["not"] if isinstance(value["not"], LISTS) else [value["not"]]
        if not unwanted:
            return F.lit(True)
        return ~F.coalesce(_has(spec, list(unwanted)), F.lit(False))
    return _has(spec, [value])


def _has(spec: IndexSpec, values: list[Any]) -> Column:
    """Any of ``values``, by token for analysed names, by element for multi-valued ones."""
    column = F.col(spec.column)
    ordered = sorted(values, key=repr)
    if not ordered:
        return F.lit(False)
    if spec.by_token:
        text = F.concat_ws("\n", column) if spec.many else column.cast("string")
        column, ordered = tokens(text), [str(value) for value in ordered]
    elif not spec.many:
        return column == F.lit(ordered[0]) if len(ordered) == 1 else column.isin(*ordered)
    if len(ordered) == 1:
        return F.array_contains(column, F.lit(ordered[0]))
    return F.arrays_overlap(column, F.array(*[F.lit(value) for value in ordered]))


def _date(name: str, value: Any, schema: T.StructType) -> Column | None:
    if not isinstance(value, Mapping) or value.get("query") in (None, [], ()):
        return None
    query, how = value["query"], value.get("range")
    if how is None and isinstance(query, (list, tuple)):
        how = "min"
    column, dtype = F.col(name), _leaf(schema, name)
    if how == "min":
        return column >= instant_literal(first_of(query), dtype)
    if how == "max":
        return column <= instant_literal(first_of(query), dtype)
    if how in ("min:max", "minmax") and isinstance(query, (list, tuple)) and len(query) == 2:
        return column.between(*(instant_literal(item, dtype) for item in query))
    return None


def _interval(name: str, value: Any, schema: T.StructType) -> Column | None:
    value, _ = _unwrap(value)
    if value in (None, ""):
        return None
    dtype = _leaf(schema, f"{name}.since")
    instant = instant_literal(value, dtype)
    return (F.col(f"{name}.since") <= instant) & (F.col(f"{name}.until") >= instant)


def _leaf(schema: T.StructType, name: str) -> T.DataType | None:
    dtype: T.DataType = schema
    for part in name.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return None
        dtype = dtype[part].dataType
    return dtype


def _path(name: str, value: Any, strict: bool) -> Column | None:
    spec = {"query": value} if isinstance(value, (str, *LISTS)) else value
    roots = spec.get("query")
    if not roots:
        return None
    roots = [roots] if isinstance(roots, str) else list(roots)
    levels = spec.get("depth", -1)
    skip = spec.get("navtree_start", 0) if spec.get("navtree") else None
    return reduce(or_, [_below(name, root, levels, skip, strict) for root in roots])


def _below(name: str, root: str, levels: int, skip: int | None, strict: bool) -> Column:
    """Rows under ``root``. ``skip`` is set for navigation trees only.

    A navigation tree counts its upper bound from the site, not from the root, and the
    prefix is compared as text; ``strict`` asks for whole path segments instead.
    """
    path, depth = F.col(f"{name}.path"), F.col(f"{name}.depth")
    if levels == 0:
        return path == root
    prefix = path.startswith(root)
    if strict:
        prefix = (path == root) | path.startswith(root.rstrip("/") + "/")
    level = root.count("/")
    if skip is not None:
        low, high = depth >= level + skip, skip + levels
    else:
        low, high = (depth >= level if levels == -1 else depth > level), level + levels
    found = prefix & low
    return found if levels == -1 else found & (depth <= high)
