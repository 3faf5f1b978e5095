"""Settings record and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Settings:
    """Options of one search index. Paging and highlighting defaults are fixed by contract."""

    enabled: bool = True
    deferred: bool = False
    search_only: frozenset[str] = frozenset({"Title", "Description", "SearchableText"})
    bulk_size: int = 50
    highlight: bool = False
    highlight_threshold: int = 600
    highlight_fragments: int = 5
    highlight_fragment_chars: int = 100
    highlight_pre_tags: str = ""
    highlight_post_tags: str = ""
    # opt-in deviations from the default query rules
    honour_operator: bool = False
    strict_subtree: bool = False
    # partitions to spread documents over before their text is analysed; 0 leaves the scan's
    # own splits, which suit tables of many files
    scan_partitions: int = 0
    # failed batches of the change feed
    retries: int = 3
    retry_seconds: float = 30.0
    # physical layout: hash buckets of documents (0: one for every ``bucket_bytes`` of text),
    # files written per bucket, the number of overlays at which folding them is due, and the
    # share of all bytes above which they are folded into the base
    buckets: int = 0
    bucket_bytes: int = 1 << 28
    files_per_bucket: int = 1
    merge_after: int = 32
    merge_share: float = 0.1

    @property
    def tags(self) -> tuple[str, str]:
        """First highlight tag pair of the newline-separated lists."""
        return (
            self.highlight_pre_tags.split("\n")[0],
            self.highlight_post_tags.split("\n")[0],
        )


_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a single-process session (master ``local``) gets a temporary folder of
    its own; on a cluster that is an error, for executors would write to disks of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.partition("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _fallback:
        _fallback[context.applicationId] = tempfile.mkdtemp(prefix="findlark-")
    return _fallback[context.applicationId]


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/findlark/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, written: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which also cuts its lineage.

    The path is added to ``written``, for whoever is to remove the table.
    """
    path = fresh_path(df.sparkSession, tag)
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written for the length of one job, removed when it is over."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = fresh_path(self.spark, tag)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def full_uri(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system Spark finds it on."""
    files, folder = _file_system(spark, path)
    return files.makeQualified(folder).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is on."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def create_exclusive(spark: SparkSession, path: str, data: bytes) -> bool:
    """Create a file with the given content; ``False`` if there is one already."""
    files, file = _file_system(spark, path)
    try:
        stream = files.create(file, False)
    except Py4JJavaError as problem:
        if "FileAlreadyExists" in str(problem.java_exception):
            return False
        raise
    stream.write(bytearray(data))
    stream.close()
    return True


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, none if there is no such folder."""
    files, folder = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def file_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    files, file = _file_system(spark, path)
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from the file system's own summary."""
    files, folder = _file_system(spark, path)
    return files.getContentSummary(folder).getLength()


# Session options this engine is written for; most are Spark's defaults.
SESSION_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """A session builder with the options of :data:`SESSION_OPTIONS`."""
    for name, value in SESSION_OPTIONS.items():
        builder = builder.config(name, value)
    return builder
