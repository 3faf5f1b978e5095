"""Sorting, paging and global positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from findlark.config import materialise


def sort_columns(keys: Sequence[tuple[str, bool]], columns: Sequence[str]) -> list[Column]:
    """Sort keys ``(name, descending)`` with nulls last, then score, then ``uid``."""
    order = []
    for name, descending in keys:
        column = F.col(name)
        order.append(column.desc_nulls_last() if descending else column.asc_nulls_last())
    if "score" in columns:
        order.append(F.desc("score"))
    order.append(F.asc("uid"))
    return order


def page(rows: DataFrame, order: Sequence[Column], start: int, size: int) -> DataFrame:
    """One page in order. Spark keeps ``start + size`` rows per task, so this is for shallow pages."""
    ordered = rows.orderBy(*order)
    return (ordered.offset(start) if start else ordered).limit(size)


def ranked(
    rows: DataFrame,
    order: Sequence[Column],
    rank: str = "rank",
    part: str | None = None,
    scratch: list[str] | None = None,
) -> DataFrame:
    """Rows with their 0-based position in the whole order, for deep paging and batches.

    A range-partitioned sort is written once with the row's number inside its partition;
    the partition sizes, one row per partition, give the offsets. No task sees more than
    its own range, and ties are spread because ``order`` ends in a unique key. ``part`` names
    a column to keep the number of the range in; the path of the table is added to ``scratch``.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = materialise(ordered.withColumn("_number", F.monotonically_increasing_id()), "ranked", scratch)
    # Spark puts the partition above the lower 33 bits and the row number into them
    ordered = ordered.withColumn("_part", F.shiftright("_number", 33))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_size"))
    # one row per partition: small whatever the data
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = ordered.join(F.broadcast(offsets), "_part")
    position = F.col("_before") + F.col("_number").bitwiseAND((1 << 33) - 1)
    numbered = numbered.withColumn(rank, position).drop("_number", "_before")
    return numbered.withColumnRenamed("_part", part) if part else numbered.drop("_part")


def running_sums(
    rows: DataFrame, group: str, order: Sequence[Column], values: Sequence[str], scratch: list[str] | None = None
) -> DataFrame:
    """Rows with ``<value>_sum``: the sum of each value over the rows of its ``group`` so far.

    Rows are range-sorted by group and ``order`` (which ends in a unique key), so a group of any size
    is spread over many tasks. Inside a range the sums are windows; what a group brings along from
    the ranges before is at most one row per range, for the group the range begins with.
    """
    placed = ranked(rows, [F.asc(group), *order], "_rank", "_range", scratch)
    parts = placed.groupBy("_range", group).agg(*[F.sum(v).alias(f"_part_{v}") for v in values])
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_range", F.col(group).alias("_of"), *[F.sum(f"_part_{v}").over(earlier).alias(f"_carried_{v}") for v in values])
    carried = carried.where(" or ".join(f"_carried_{v} is not null" for v in values))
    so_far = Window.partitionBy("_range", group).orderBy("_rank")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.alias("r").join(
        F.broadcast(carried).alias("c"),
        (F.col("r._range") == F.col("c._range")) & F.col(f"r.{group}").eqNullSafe(F.col("c._of")),
        "left",
    )
    joined = joined.select("r.*", *[f"c._carried_{v}" for v in values])
    sums = {f"{v}_sum": F.sum(v).over(so_far) + F.coalesce(f"_carried_{v}", F.lit(0)) for v in values}
    return joined.withColumns(sums).drop("_rank", "_range", *[f"_carried_{v}" for v in values])


def with_batches(ranked_rows: DataFrame, size: int, rank: str = "rank") -> DataFrame:
    """Number of the batch or bucket of ``size`` rows each row falls in."""
    return ranked_rows.withColumn("batch", F.floor(F.col(rank) / size).cast("long"))


def deep_page(ranked_rows: DataFrame, start: int, size: int, rank: str = "rank") -> DataFrame:
    """A page of ranked rows by a plain range filter, however deep."""
    return ranked_rows.where(F.col(rank).between(start, start + size - 1))
