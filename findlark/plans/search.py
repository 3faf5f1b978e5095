"""Searching an index: lazy results, pages, rows of the catalog."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from findlark.config import Settings, materialise, remove
from findlark.operators import ordering
from findlark.operators.catalogjoin import join_catalog
from findlark.operators.firstpage import FirstPage
from findlark.operators.highlight import EXTRACT, describe_hits
from findlark.operators.places import Places
from findlark.operators.predicates import allowed_for, in_effect
from findlark.operators.textmatch import ScannedText, StoredText, highlight_words, match_text
from findlark.plans.query import Assembler, CompiledQuery, compile_query
from findlark.registry import Registry


@dataclass
class SearchIndex:
    """Index rows with their registry; ``text`` tells where word positions come from."""

    rows: DataFrame
    registry: Registry
    settings: Settings = field(default_factory=Settings)
    text: ScannedText | StoredText | None = None
    assemble: Assembler = compile_query
    queries: int = 0

    def __post_init__(self) -> None:
        if self.text is None:
            self.text = ScannedText(self.rows, partitions=self.settings.scan_partitions)

    def search(
        self, query: Mapping[str, Any], row_factory: Callable[[DataFrame], DataFrame] | None = None
    ) -> Results:
        """Unrestricted search. Without a text key this is a plain filter on the index rows."""
        self.queries += 1
        plan = self.assemble(query, self.registry, self.rows.schema, self.settings)
        best = None
        if plan.has_text:
            hits = lambda: match_text(self.text, plan.clauses, plan.where)
            if isinstance(self.text, StoredText) and not plan.sort:
                best = lambda size: FirstPage(self.text, plan.clauses, plan.where, size).rows()
        else:
            hits = self.rows if plan.where is None else self.rows.where(plan.where)
            hits = hits.withColumn("score", F.lit(1.0 if plan.match_all else 0.0))
        return Results(hits, plan, self.settings, row_factory, best)

    def restricted_search(
        self,
        query: Mapping[str, Any],
        principals: Iterable[str],
        *,
        now: datetime | None = None,
        sees_inactive: bool = False,
        row_factory: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Results:
        """Search limited to what the principals may see and, by default, to what is in effect."""
        visible = allowed_for("allowedRolesAndUsers", principals)
        # the viewer's own conditions take the place of what the caller asks for on these keys
        query = {name: spec for name, spec in query.items() if name != "allowedRolesAndUsers"}
        if not query.pop("show_inactive", False) and not sees_inactive:
            visible &= in_effect("effectiveRange", self.rows.schema, now)
            query.pop("effectiveRange", None)
        inner = self.assemble

        def with_visibility(*args) -> CompiledQuery:
            plan = inner(*args)
            where = visible if plan.where is None else plan.where & visible
            return CompiledQuery(where, plan.clauses, plan.sort, plan.has_text)

        restricted = SearchIndex(self.rows, self.registry, self.settings, self.text, with_visibility)
        self.queries += 1
        return restricted.search(query, row_factory)


class Results:
    """The full, lazy result of a search.

    ``hits`` is unordered and has every index column and ``score``. Indexing with a number
    fetches one page of ``bulk_size`` rows of the ranked result and keeps the latest few; a
    slice is a lazy frame. Neither sorts the whole result, see :class:`Places`. :meth:`close`
    removes what was written for :meth:`ranked` and long slices.
    """

    PAGES_KEPT = 8

    def __init__(
        self,
        hits: DataFrame | Callable[[], DataFrame],
        plan: CompiledQuery,
        settings: Settings,
        row_factory: Callable[[DataFrame], DataFrame] | None = None,
        best: Callable[[int], DataFrame | None] | None = None,
    ):
        self.plan, self.settings = plan, settings
        self._found, self._factory, self._best = hits, row_factory, best
        self._pages: OrderedDict[int, list[Row]] = OrderedDict()
        self._count: int | None = None
        self._ranked: DataFrame | None = None
        self._scratch: list[str] = []

    @cached_property
    def _hits(self) -> DataFrame:
        """All hits; their expressions are only built when something asks for them."""
        return self._found() if callable(self._found) else self._found

    @property
    def order(self) -> list:
        keys = [(self._sort_name(name), down) for name, down in self.plan.sort]
        return ordering.sort_columns(keys, self._hits.columns)

    def _sort_name(self, name: str) -> str:
        dtype = self._hits.schema[name].dataType
        return f"{name}.path" if "path" in getattr(dtype, "names", ()) else name

    def _shown(self, rows: DataFrame, extract: bool = False) -> DataFrame:
        """Highlighting and the caller's row function, for the rows that are shown."""
        if self.settings.highlight and "SearchableText" in rows.columns:
            pre, post = self.settings.tags
            rows = describe_hits(
                rows,
                highlight_words(self.plan.clauses),
                pre=pre,
                post=post,
                threshold=self.settings.highlight_threshold,
                count=self.settings.highlight_fragments,
                chars=self.settings.highlight_fragment_chars,
            )
            rows = rows if extract else rows.drop(EXTRACT)
        return rows.transform(self._factory) if self._factory else rows

    @property
    def hits(self) -> DataFrame:
        return self._shown(self._hits)

    def ordered(self) -> DataFrame:
        """All hits in order."""
        return self._shown(self._hits.orderBy(*self.order))

    def fields(self, *names: str) -> DataFrame:
        """Hits reduced to the wanted stored fields, their path if none are named."""
        if not names:
            return self._hits.select("uid", F.col("path.path").alias("path"), "score")
        return self._hits.select("uid", *names, "score")

    def page(self, start: int, size: int | None = None) -> DataFrame:
        """Rows ``start`` to ``start + size`` of the order, for a page near the top.

        Spark keeps the first ``start + size`` rows of every task and merges them; far from
        the top :meth:`deep_page` is the one to call. On a stored index in order of relevance, hits
        that cannot be among these rows are not scored (:class:`FirstPage`; a few small jobs run
        when this is called).
        """
        size = size or self.settings.bulk_size
        first = self._best(start + size) if self._best else None
        if first is None:
            return self._shown(ordering.page(self._hits, self.order, start, size))
        return self._shown(ordering.page(first, ordering.sort_columns([], first.columns), start, size))

    def ranked(self) -> DataFrame:
        """Ids with their place in the order, written once: for passes over the whole ranking."""
        if self._ranked is None:
            names = [name.split(".")[0] for name, _ in self.plan.sort]
            keys = self._hits.select(*dict.fromkeys(["uid", *names, "score"]))
            if self.plan.has_text:
                # a range sort reads its input twice, to sample and to sort
                keys = materialise(keys, "hits", self._scratch)
            self._ranked = ordering.ranked(keys, self.order, scratch=self._scratch)
        return self._ranked

    def close(self) -> None:
        """Remove the tables the ranked result was written to."""
        if self._scratch:
            spark, self._ranked = self._hits.sparkSession, None
            while self._scratch:
                remove(spark, self._scratch.pop())
            self._pages.clear()

    def deep_page(self, start: int, size: int | None = None) -> DataFrame:
        """As :meth:`page`, for a start far into the result."""
        return self._shown(self._placed(start, size or self.settings.bulk_size).orderBy("rank").drop("rank"))

    def _placed(self, start: int, size: int) -> DataFrame:
        return self._hits.join(self._places.between(start, start + size), "uid")

    @cached_property
    def _places(self) -> Places:
        keys = [(self._sort_name(name), down) for name, down in self.plan.sort]
        keys += [("score", True)] if "score" in self._hits.columns else []
        return Places(self._hits, [*keys, ("uid", False)], self.count(), scratch=self._scratch)

    def count(self) -> int:
        if self._count is None:
            self._count = self._hits.count()
        return self._count

    def __len__(self) -> int:
        return self.count()

    def __getitem__(self, key: int | slice) -> Row | DataFrame:
        if isinstance(key, slice):
            places = range(*key.indices(self.count()))
            if not places:
                return self._shown(self._hits.limit(0))
            low, high = min(places[0], places[-1]), max(places[0], places[-1])
            rows = self._placed(low, high - low + 1).where((F.col("rank") - places[0]) % abs(places.step) == 0)
            return self._shown(rows.orderBy(F.col("rank") * (1 if places.step > 0 else -1)).drop("rank"))
        place = key + self.count() if key < 0 else key
        if not 0 <= place < self.count():
            raise IndexError(key)
        size = self.settings.bulk_size
        start = place // size * size
        if start not in self._pages:
            self._pages[start] = self.deep_page(start, size).collect()
            if len(self._pages) > self.PAGES_KEPT:
                self._pages.popitem(last=False)
        return self._pages[start][place - start]

    def rows(self, catalog: DataFrame) -> DataFrame:
        """Hits with the catalog's row, or their own index record where the catalog has none."""
        return self._with_catalog(self._hits, catalog)

    def _with_catalog(self, hits: DataFrame, catalog: DataFrame) -> DataFrame:
        shown = self._shown(hits, extract=True).withColumn("path", F.col("path.path"))
        joined = join_catalog(shown, catalog)
        if EXTRACT not in joined.columns:
            return joined
        # the row that is handed to the user shows the extract too, whoever it comes from
        row = F.col("row")
        if "Description" in catalog.columns:
            told = F.when(F.col(EXTRACT).isNull(), row["Description"]).otherwise(F.col(EXTRACT))
            row = F.when(row.isNotNull(), row.withField("Description", told))
        return joined.withColumn("row", row).drop(EXTRACT)

    def page_rows(self, start: int, catalog: DataFrame, size: int | None = None) -> DataFrame:
        """One page with its catalog rows, in order, and their ``place``.

        The catalog is reduced to the paths of the page before it is joined.
        """
        hits = self._placed(start, size or self.settings.bulk_size).withColumnRenamed("rank", "place")
        paths = hits.select(F.col("path.path").alias("path"))
        return self._with_catalog(hits, catalog.join(paths, "path", "left_semi")).orderBy("place")
