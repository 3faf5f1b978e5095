"""Rows by their place in an order, found by counting instead of sorting everything."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.operators import ordering

Key = tuple[str, bool]


class Places:
    """Access by place to ``rows`` in the order of ``keys``, ``(name, descending)``, nulls last.

    The last key is unique. A table of *cuts*, key values with the exact number of rows before
    them, is grown around the places that are asked for: rows drawn at random propose cuts, one
    pass without a shuffle counts the rows before each, and the range that holds a place is cut
    again while it has more than ``range_rows`` rows. Only the rows between two cuts are sorted.
    The draw decides what work is done, never which row has a place. Places within ``near`` rows
    of either end are taken by Spark's top-k. The driver holds ``cuts`` keys a pass, one of every
    ``DRAWN`` rows drawn.
    """

    DRAWN = 32

    def __init__(
        self,
        rows: DataFrame,
        keys: Sequence[Key],
        count: int,
        *,
        near: int = 10_000,
        range_rows: int = 1 << 18,
        cuts: int = 32,
        scratch: list[str] | None = None,
    ):
        self.keys, self.total, self.scratch = list(keys), count, scratch
        # fields of structs get names of their own
        columns = {f"_k{i}": F.col(name) for i, (name, _) in enumerate(self.keys)}
        self.rows = rows.select("uid", *[column.alias(name) for name, column in columns.items()])
        self.near, self.range_rows, self.cuts = near, range_rows, cuts
        self._before, self._values = [0, count], [None, None]

    # --- order ---

    def _order(self, reverse: bool = False) -> list[Column]:
        order = []
        for i, (_, down) in enumerate(self.keys):
            column = F.col(f"_k{i}")
            if reverse:
                order.append(column.asc_nulls_first() if down else column.desc_nulls_first())
            else:
                order.append(column.desc_nulls_last() if down else column.asc_nulls_last())
        return order

    def _literal_keys(self) -> list[tuple[str, bool, T.DataType]]:
        """The leading keys whose values can be written as literals; a cut by them alone is a cut."""
        found = []
        for i, (_, down) in enumerate(self.keys):
            kind = self.rows.schema[f"_k{i}"].dataType
            if not isinstance(kind, T.AtomicType) or isinstance(kind, T.BinaryType):
                break
            found.append((f"_k{i}", down, kind))
        return found

    def precedes(self, values: Sequence[object]) -> Column:
        """Whether a row comes before the given key values."""
        result = F.lit(False)
        for (name, down, kind), value in reversed(list(zip(self._literal_keys(), values))):
            column = F.col(name)
            if value is None:
                less, same = column.isNotNull(), column.isNull()
            else:
                value = F.lit(value).cast(kind)
                less = F.coalesce(column > value if down else column < value, F.lit(False))
                same = column.eqNullSafe(value)
            result = less | (same & result)
        return result

    # --- cuts ---

    def _between(self, low: int, high: int) -> DataFrame:
        """Rows from the cut numbered ``low`` to the one numbered ``high``."""
        rows = self.rows
        if self._values[low] is not None:
            rows = rows.where(~self.precedes(self._values[low]))
        if self._values[high] is not None:
            rows = rows.where(self.precedes(self._values[high]))
        return rows

    def _cut(self, low: int) -> bool:
        """Cut the range that begins at the cut numbered ``low``; ``False`` if it cannot be."""
        names = [name for name, *_ in self._literal_keys()]
        size = self._before[low + 1] - self._before[low]
        if not names:
            return False
        rows = self._between(low, low + 1)
        share = min(1.0, self.DRAWN * self.cuts / size)
        drawn = rows.select(*names).sample(share, seed=len(self._before)).limit(2 * self.DRAWN * self.cuts)
        drawn = [tuple(row) for row in drawn.orderBy(*self._order()[: len(names)]).collect()]
        step = max(1, len(drawn) // self.cuts)
        values = list(dict.fromkeys(drawn[step // 2 :: step]))
        if not values:
            return False
        counts = rows.agg(*[F.count_if(self.precedes(v)).alias(f"c{i}") for i, v in enumerate(values)]).first()
        inside = {n: v for n, v in sorted(zip(counts, values), key=lambda c: c[0]) if 0 < n < size}
        start = self._before[low]
        self._before[low + 1 : low + 1] = [start + n for n in inside]
        self._values[low + 1 : low + 1] = list(inside.values())
        return bool(inside)

    def _range_of(self, place: int) -> int:
        """Number of the cut before ``place``, in a range small enough to be sorted."""
        while True:
            low = bisect_right(self._before, place, hi=len(self._before) - 1) - 1
            if self._before[low + 1] - self._before[low] <= self.range_rows or not self._cut(low):
                return low

    # --- rows ---

    def between(self, start: int, stop: int) -> DataFrame:
        """``uid`` and ``rank`` of the rows at places ``start`` to ``stop - 1``.

        At most ``near`` places are numbered in one task, more of them over sorted ranges. So are
        those of rows that no cut divides, as lists that no literal stands for do not.
        """
        stop = min(stop, self.total)
        size = stop - start
        if size <= 0:
            return self.rows.limit(0).select("uid", F.lit(0).cast("long").alias("rank"))
        if stop <= self.near:
            return self._taken(self.rows, start, size, start)
        if self.total - start <= self.near:
            last = self.total - stop
            rows = self._taken(self.rows, last, size, last, reverse=True)
            return rows.select("uid", (F.lit(self.total - 1) - F.col("rank")).alias("rank"))
        first = self._range_of(start)
        self._range_of(stop - 1)
        # cuts made for the end come after those of the start
        first = bisect_right(self._before, start, hi=len(self._before) - 1) - 1
        last = bisect_left(self._before, stop)
        rows, before = self._between(first, last), self._before[first]
        if size <= self.near and self._before[last] - before <= 2 * self.range_rows:
            return self._taken(rows, start - before, size, start)
        placed = ordering.ranked(rows, self._order(), scratch=self.scratch).withColumn("rank", F.col("rank") + before)
        return ordering.deep_page(placed, start, size).select("uid", "rank")

    def _taken(self, rows: DataFrame, skip: int, size: int, rank: int, reverse: bool = False) -> DataFrame:
        order = self._order(reverse)
        taken = ordering.page(rows, order, skip, size)
        # at most ``near`` rows
        number = F.row_number().over(Window.orderBy(*order))
        return taken.select("uid", (number + F.lit(rank - 1)).cast("long").alias("rank"))
