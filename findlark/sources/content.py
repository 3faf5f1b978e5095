"""Index rows derived from a content table, one row per object."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.functions.text import bytes_to_text
from findlark.functions.values import null_like, parse_instant, path_struct
from findlark.registry import IndexSpec, Registry

Provider = Callable[[DataFrame], DataFrame]


def extract(content: DataFrame, spec: IndexSpec) -> Column:
    """The indexed value of ``spec``; an attribute that cannot be derived is null."""
    by_kind = {
        "text": _text,
        "date": _date,
        "recurring": _date,
        "daterange": _date_range,
        "path": _path,
        "boolean": lambda df, s: _first(df, s).try_cast("boolean"),
        "position": lambda df, s: _first(df, s).try_cast("int"),
    }
    value = by_kind.get(spec.kind, _plain)(content, spec)
    return value.try_cast(spec.data_type).alias(spec.name)


def derive_rows(
    content: DataFrame,
    registry: Registry,
    attributes: Iterable[str] | None = None,
    *,
    search_only: Iterable[str] = (),
    indexers: Mapping[str, Column] | None = None,
    providers: Sequence[Provider] = (),
) -> DataFrame:
    """Index rows with the requested attributes, all of them if none are named.

    A search-only name without a registered index is taken from the named indexer
    expression, else from the content column of that name. Each provider sees the row so
    far and may add or replace columns.
    """
    wanted = list(attributes or ()) or registry.all_attributes(search_only)
    indexers = indexers or {}
    columns = [F.col("uid")]
    for name in wanted:
        if name in registry and registry[name].is_key:
            continue
        if name in registry:
            columns.append(extract(content, registry[name]))
        elif name in set(search_only):
            if name in indexers:
                value = indexers[name]
            elif name in content.columns:
                value = _as_text(F.col(name), content.schema[name].dataType)
            else:
                value = F.lit(None).cast("string")
            columns.append(value.alias(name))
        else:
            columns.append(F.lit(None).cast("string").alias(name))
    rows = content.select(*columns)
    for provider in providers:
        rows = rows.transform(provider)
    return rows


def read_back(rows: DataFrame, registry: Registry) -> DataFrame:
    """Stored values as a caller reads them: empty defaults, the plain path of a path index."""
    columns = []
    for field in rows.schema:
        spec = registry.get(field.name)
        value = F.col(field.name)
        if spec is None or spec.kind in ("date", "recurring", "daterange"):
            columns.append(value)
        elif spec.kind == "path":
            columns.append(value["path"].alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.coalesce(value, F.array().cast(field.dataType)).alias(field.name))
        elif isinstance(field.dataType, T.StringType):
            columns.append(F.coalesce(value, F.lit("")).alias(field.name))
        else:
            columns.append(value)
    return rows.select(*columns)


def _type(content: DataFrame, name: str) -> T.DataType | None:
    return content.schema[name].dataType if name in content.columns else None


def _as_text(value: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, T.BinaryType):
        return bytes_to_text(value)
    if isinstance(dtype, T.StringType):
        return null_like(value)
    return value


def _first(content: DataFrame, spec: IndexSpec) -> Column:
    """Value of the first source attribute; a source the content lacks is null."""
    name = spec.columns[0]
    if name not in content.columns:
        return F.lit(None).cast("string")
    return _as_text(F.col(name), _type(content, name))


def _plain(content: DataFrame, spec: IndexSpec) -> Column:
    value = _first(content, spec)
    dtype = _type(content, spec.columns[0])
    if spec.many and not isinstance(dtype, T.ArrayType):
        return F.when(value.isNotNull(), F.array(value))
    if not spec.many and isinstance(dtype, T.ArrayType):
        return F.get(value, F.lit(0))
    return value


def _text(content: DataFrame, spec: IndexSpec) -> Column:
    parts = []
    for name in spec.columns:
        dtype = _type(content, name)
        if isinstance(dtype, T.StringType):
            parts.append(F.when(F.col(name) != "", F.col(name)))
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
            parts.append(F.col(name))
    return null_like(F.concat_ws("\n", *parts)) if parts else F.lit("")


def _date(content: DataFrame, spec: IndexSpec) -> Column:
    name = spec.columns[0]
    dtype = _type(content, name)
    if dtype is None:
        return parse_instant(F.lit(None).cast("string"))
    value = F.col(name)
    if isinstance(dtype, T.ArrayType):
        value, dtype = F.get(value, F.lit(0)), dtype.elementType
    if isinstance(dtype, T.StringType):
        return parse_instant(value)
    return F.coalesce(value.cast("timestamp"), parse_instant(F.lit(None).cast("string")))


def _date_range(content: DataFrame, spec: IndexSpec) -> Column:
    if len(spec.sources) != 2 or not set(spec.sources) <= set(content.columns):
        return F.lit(None)
    since, until = (_instant(content, name) for name in spec.sources)
    both = since.isNotNull() & until.isNotNull()
    return F.when(both, F.struct(since.alias("since"), until.alias("until")))


def _instant(content: DataFrame, name: str) -> Column:
    if isinstance(_type(content, name), T.StringType):
        return F.try_to_timestamp(F.nullif(F.col(name), F.lit("")))
    return F.col(name).cast("timestamp")


def _path(content: DataFrame, spec: IndexSpec) -> Column:
    name = spec.columns[0]
    dtype = _type(content, name)
    if isinstance(dtype, T.StringType):
        return path_struct(F.col(name))
    if isinstance(dtype, T.ArrayType):
        return path_struct(F.array_join(F.col(name), "/"))
    if isinstance(dtype, T.StructType) and set(dtype.names) == {"path", "depth"}:
        return F.struct(F.col(name)["path"].alias("path"), F.col(name)["depth"].alias("depth"))
    if dtype is None:
        return F.lit(None)
    raise TypeError(f"a path is text or an array of text, but {name} is {dtype.simpleString()}")
