"""Binary fields of content objects and their bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.functions.values import relative_path


def blob_fields(content: DataFrame, root: str, files: str = "files") -> DataFrame:
    """One row per non-empty file field of each object, images left out.

    ``files`` is a map from field name to ``struct<filename, content_type, ...>``; the
    object's ``path`` text is made relative to ``root``.
    """
    entry = F.explode(F.map_entries(files)).alias("entry")
    rows = content.select("uid", F.col("path").alias("object_path"), entry)
    value = F.col("entry.value")
    keep = value["filename"].isNotNull() & ~F.coalesce(
        value["content_type"].startswith("image/"), F.lit(False)
    )
    return rows.where(keep).select(
        "uid",
        F.col("entry.key").alias("fieldname"),
        relative_path(F.col("object_path"), root).alias("path"),
        value["filename"].alias("filename"),
    )


def list_blobs(spark: SparkSession, base: str) -> DataFrame:
    """Files at ``<base>/<path>/@@download/<fieldname>`` with their ``uri`` and ``length``; none is opened."""
    # the part of the file name below ``base``, without a scheme
    below = rf"\Q{base.split(':')[-1].rstrip('/')}\E/(.*)/@@download/([^/]+)$"
    name = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return files.select(
        F.regexp_extract(name, below, 1).alias("path"),
        F.regexp_extract(name, below, 2).alias("fieldname"),
        name.alias("uri"),
        "length",
    )


def open_uri(uri: str) -> bytes:
    """Content of a file of any file system Arrow knows."""
    system, path = _arrow_path(uri)
    with system.open_input_stream(path) as stream:
        return stream.read()


def _arrow_path(uri: str):
    # local files by their plain path: their names may hold characters a URI would escape
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def read_blobs(
    spark: SparkSession, base: str, fields: DataFrame, reader: Callable[[str], bytes] = open_uri
) -> DataFrame:
    """Descriptors with their bytes, read from ``<base>/<path>/@@download/<fieldname>``.

    The listing is joined first, so only the files of the descriptors are opened, one by one in the
    tasks that hold them. ``reader`` takes a full URI, for file systems Arrow does not know.
    """
    found = fields.join(list_blobs(spark, base).drop("length"), ["path", "fieldname"])
    kept = found.drop("uri")
    schema = T.StructType([*kept.schema.fields, T.StructField("data", T.BinaryType())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("uri")
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            # one file at a time: a batch of large files would not fit
            for row, uri in enumerate(batch.column(at)):
                data = pa.array([reader(uri.as_py())], pa.binary())
                yield pa.RecordBatch.from_arrays([*[c.slice(row, 1) for c in columns], data], schema.names)

    return found.select(*kept.columns, "uri").mapInArrow(load, schema)


def write_blobs(files: DataFrame, base: str) -> DataFrame:
    """Write ``path, fieldname, data`` rows to ``<base>/<path>/@@download/<fieldname>``; one row per
    file with its ``length``. A file is written under another name first, so an attempt that is
    lost leaves no half of it."""
    schema = T.StructType.fromDDL("path string, fieldname string, length long")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                system, folder = _arrow_path(f"{base}/{row['path']}/@@download")
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{row['fieldname']}-{uuid.uuid4().hex}"
                with system.open_output_stream(part) as stream:
                    stream.write(row["data"])
                system.move(part, f"{folder}/{row['fieldname']}")
            columns = [[r["path"] for r in rows], [r["fieldname"] for r in rows], [len(r["data"]) for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], schema.names)

    return files.select("path", "fieldname", "data").mapInArrow(store, schema)
