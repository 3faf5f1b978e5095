"""Dates, paths, null-likes and other small value functions."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_DATE = "1900-01-01T00:00:00+00:00"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def first_of(value):
    """First element of a list-like Python value, any other value unchanged."""
    if isinstance(value, (list, tuple)):
        return value[0]
    return value


def to_instant(value: str | date | datetime) -> datetime:
    """A date, ISO text or datetime as an aware UTC datetime; a bare date is its midnight."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip().replace("/", "-"))
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)


def instant_literal(value: str | date | datetime, dtype: T.DataType | None = None) -> Column:
    """A literal in the column's own timestamp type, so the comparison reaches the scan."""
    instant = to_instant(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(instant.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(instant.isoformat()).cast("timestamp")


def null_like(value: Column) -> Column:
    """The text ``None`` counts as null."""
    return F.when(value != "None", value)


def parse_instant(value: Column) -> Column:
    """Text to timestamp; null, empty and ``None`` give the missing date, other bad text null."""
    missing = value.isNull() | value.isin("", "None")
    return F.when(missing, F.lit(MISSING_DATE).cast("timestamp")).otherwise(
        F.try_to_timestamp(F.replace(value, F.lit("/"), F.lit("-")))
    )


def iso_text(instant: Column) -> Column:
    """Timestamp as ISO-8601 text with offset."""
    return F.date_format(instant.cast("timestamp"), ISO_FORMAT)


def path_segments(path: Column) -> Column:
    return F.split(path, "/", -1)


def path_depth(path: Column) -> Column:
    return F.size(path_segments(path)) - 1


def path_struct(path: Column) -> Column:
    """Path with its depth, null for a null path."""
    return F.when(
        path.isNotNull(), F.struct(path.alias("path"), path_depth(path).cast("int").alias("depth"))
    )


def join_segments(segments: Column) -> Column:
    return F.array_join(segments, "/")


def parent_path(path: Column) -> Column:
    """Everything before the last segment."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def relative_path(path: Column, root: str) -> Column:
    """Segments below ``root``, joined."""
    below = len(root.rstrip("/").split("/"))
    segments = path_segments(path)
    return F.array_join(F.slice(segments, F.lit(below + 1), F.size(segments)), "/")


def absolute_url(url: Column, base: Column | str) -> Column:
    """Site-relative links get the base in front."""
    prefix = F.lit(base) if isinstance(base, str) else base
    return F.when(url.startswith("/"), F.concat(prefix, url)).otherwise(url)


def size_mb(n_bytes: Column) -> Column:
    """Bytes as whole megabytes, rounded up."""
    return F.concat(F.ceil(n_bytes / 1024 / 1024).cast("string"), F.lit(" MB"))


def line_list(text: Column) -> Column:
    return F.split(text, "\n", -1)


def index_name(path: str, custom: str | None = None, version: int | None = None) -> str:
    """Name of an index from its site path; a custom name wins and carries no version."""
    if custom:
        return custom
    name = "-".join(path.split("/")[1:]).lower()
    return f"{name}_{version}" if version else name
