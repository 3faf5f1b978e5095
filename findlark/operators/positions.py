"""Order of members in their container, and what a move changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from findlark.operators.ordering import ranked, running_sums


def container_positions(
    members: DataFrame, parent: str, member: str, order: str | None = None
) -> DataFrame:
    """Members with their 0-based ``position`` in the container.

    Positions come from one global order by container and place. A container may hold any
    share of the rows: it is then spread over many ranges, and each row finds the start of
    its container inside its own range or, for the container a range begins with, in a
    table of one row per range.
    """
    place = [F.asc(parent), *([F.asc(order)] if order else []), F.asc(member)]
    placed = ranked(members, place, "_rank", "_range")
    joined = placed.join(F.broadcast(_range_starts(placed, parent)), "_range")
    in_range = Window.partitionBy("_range").orderBy("_rank")
    begins = ~F.col(parent).eqNullSafe(F.lag(parent).over(in_range))
    begin = F.when(begins & F.lag("_rank").over(in_range).isNotNull(), F.col("_rank"))
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = joined.withColumn("_begin", begin)
    start = F.coalesce(F.last("_begin", ignorenulls=True).over(so_far), F.col("_carried"))
    return joined.withColumn("position", (F.col("_rank") - start).cast("int")).drop(
        "_rank", "_range", "_carried", "_begin"
    )


def _range_starts(placed: DataFrame, parent: str) -> DataFrame:
    """Per range, the rank at which the container of its first row begins, maybe ranges before."""
    runs = placed.groupBy("_range", parent).agg(F.min("_rank").alias("_start"))
    ranges = runs.groupBy("_range").agg(
        F.min("_start").alias("_first"),
        F.max("_start").alias("_last"),
        F.min_by(parent, "_start").alias("_first_parent"),
        F.max_by(parent, "_start").alias("_last_parent"),
    )
    # from here on one row per range
    along = Window.orderBy("_range")
    opens = F.lag("_first").over(along).isNull() | ~F.col("_first_parent").eqNullSafe(
        F.lag("_last_parent").over(along)
    )
    ranges = ranges.withColumn("_opens", opens)
    # start of the last container of a range, unless it comes from a range before
    known = F.when((F.col("_last") > F.col("_first")) | F.col("_opens"), F.col("_last"))
    ranges = ranges.withColumn("_known", known)
    earlier = F.last("_known", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carried = F.when(F.col("_opens"), F.col("_first")).otherwise(earlier)
    return ranges.select("_range", carried.alias("_carried"))


def move_members(
    positions: DataFrame, moves: DataFrame, parent: str, member: str
) -> DataFrame:
    """Positions after moving some members by a delta, as ``position_after``.

    ``moves`` is ``(parent, member, delta)``, all deltas of a container having one sign. A
    moved member goes to its position plus delta, clamped to the container; the others fill
    the free places in their old order. Only containers with moves are returned.

    Nothing is gathered per container. The number of moved members before each member is a running
    sum over the container's order. A target then passes all unmoved members whose number is not
    below its place less the targets before it; targets and unmoved members are put in one order
    by these numbers, where the targets passed are again a running sum.
    """
    place = "position"
    known = moves.select(parent, member, F.col("delta").alias("_delta"))
    concerned = positions.join(known, [parent, member], "left")
    concerned = concerned.withColumn("_moved", F.col("_delta").isNotNull().cast("long"))
    asked = concerned.where("_moved = 1").groupBy(parent).agg(F.count("*").alias("_moves"))
    sizes = concerned.groupBy(parent).agg((F.max(place) + 1).alias("_n")).join(asked, parent)
    concerned = concerned.join(asked.select(parent), parent, "left_semi")
    counted = running_sums(concerned, parent, [F.asc(place), F.asc(member)], ["_moved"])
    # moved members from the first on, and the unmoved before a member
    turn, unmoved = F.col("_moved_sum") - 1, F.col(place) - F.col("_moved_sum")
    goal = F.col(place) + F.col("_delta")
    down = F.least(goal, F.col("_n") - F.col("_moves") + turn)
    target = F.when(F.col("_delta") < 0, F.greatest(goal, turn)).otherwise(down)
    targets = counted.where("_moved = 1").join(sizes, parent).withColumn("_to", target.cast("long"))
    targets = targets.withColumn("_key", F.col("_to") - turn).select(*counted.columns, "_to", "_key")
    others = counted.where("_moved = 0").withColumn("_to", F.lit(None).cast("long"))
    others = others.withColumn("_key", unmoved.cast("long")).select(*counted.columns, "_to", "_key")
    events = targets.unionByName(others).withColumnRenamed("_moved", "_event").drop("_moved_sum")
    order = [F.asc("_key"), F.desc("_event"), F.asc(place), F.asc(member)]
    passed = running_sums(events, parent, order, ["_event"])
    after = F.coalesce("_to", F.col("_key") + F.col("_event_sum"))
    return passed.select(*positions.columns, after.cast("int").alias("position_after"))


def changed_positions(moved: DataFrame, content_only: str | None = None) -> DataFrame:
    """Members whose position changed; with ``content_only``, rows where that column is true."""
    rows = moved.where(F.col("position") != F.col("position_after"))
    return rows.where(F.col(content_only)) if content_only else rows
