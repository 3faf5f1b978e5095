"""Placing numbered documents in a folder hierarchy, in depth-first order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Shape and content types of the demo hierarchy.
FOLDERS_PER_LEVEL = 6
PAGES_PER_FOLDER = 50
MAX_DEPTH = 4
PAGE_TYPES = ("Document", "News Item", "Event")


def folder_count(depth: int = MAX_DEPTH, folders: int = FOLDERS_PER_LEVEL) -> int:
    return sum(folders**level for level in range(1, depth + 1))


def folder_path(
    number: Column, depth: int = MAX_DEPTH, folders: int = FOLDERS_PER_LEVEL
) -> Column:
    """Path of the ``number``-th folder, depth first: ``folder2/folder0`` and so on."""
    path, rest, done = F.lit(""), number, F.lit(False)
    for level in range(depth):
        size = 1 + folder_count(depth - level - 1, folders)
        step = F.concat(
            path,
            F.lit("/" if level else ""),
            F.lit("folder"),
            F.floor(rest / F.lit(size)).cast("int").cast("string"),
        )
        path = F.when(done, path).otherwise(step)
        inside = rest % size
        done = done | (inside == 0)
        rest = inside - 1
    return path


def place(
    numbered: DataFrame,
    slot: str,
    site: str = "/site",
    *,
    depth: int = MAX_DEPTH,
    folders: int = FOLDERS_PER_LEVEL,
    pages: int = PAGES_PER_FOLDER,
) -> DataFrame:
    """Give each row a ``path`` and ``page_type`` from its slot number.

    A full hierarchy is followed by another one: ``/site0``, ``/site1`` and so on.
    """
    total = folder_count(depth, folders)
    folder = F.floor(F.col(slot) / pages).cast("long")
    root = F.concat(F.lit(site), F.floor(folder / total).cast("long").cast("string"))
    path = F.concat(
        root,
        F.lit("/"),
        folder_path(folder % total, depth, folders),
        F.lit("/page"),
        (F.col(slot) % pages).cast("string"),
    )
    draw = F.conv(F.substring(F.md5(F.col(slot).cast("string").cast("binary")), 1, 8), 16, 10)
    kind = F.element_at(
        F.array(*[F.lit(name) for name in PAGE_TYPES]),
        (draw.cast("long") % len(PAGE_TYPES) + 1).cast("int"),
    )
    return numbered.withColumn("path", path).withColumn("page_type", kind)


def folder_rows(spark: SparkSession, site: str = "/site", depth: int = MAX_DEPTH, folders: int = FOLDERS_PER_LEVEL) -> DataFrame:
    """The folders of one hierarchy."""
    rows = spark.range(folder_count(depth, folders))
    path = F.concat(F.lit(f"{site}/"), folder_path(F.col("id"), depth, folders))
    return rows.select(path.alias("path"), F.lit("Folder").alias("page_type"))
