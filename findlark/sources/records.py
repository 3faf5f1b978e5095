"""Id scans and look-ups by path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index_ids(rows: DataFrame) -> DataFrame:
    """All ids of the index; only the key column is read."""
    return rows.select("uid")


def unique_values(rows: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def record_by_path(rows: DataFrame, path: str) -> DataFrame:
    """The index record at ``path``, empty if there is none. The first by uid on duplicates."""
    return rows.where(F.col("path.path") == path).orderBy("uid").limit(1)


def records_by_paths(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """Batch form: one row per wanted path, null columns where nothing is stored."""
    named = rows.withColumn("_path", F.col("path.path")).drop("path")
    return paths.select(F.col("path").alias("_path")).join(named, "_path", "left").withColumnRenamed(
        "_path", "path"
    )


def catalog_by_paths(catalog: DataFrame, paths: DataFrame) -> DataFrame:
    """Catalog row of each path; an unknown path keeps null columns."""
    return paths.select("path").join(catalog, "path", "left")
