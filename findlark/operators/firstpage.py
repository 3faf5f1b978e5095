"""The first rows of a ranked search on a stored index, without scoring all its hits.

Postings of a word lie in runs of falling worth, and for every run the table of words knows what
none of its postings can exceed. A few of the best postings give documents whose exact scores
set a threshold; then as much of each word's runs is read as is needed to bring the bound of what
is left unread below it. Only documents whose own bound reaches the threshold are scored, from
their texts. All bounds hold for the present word counts, so the result is that of scoring
every hit, ties included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.operators.postings import saturation
from findlark.operators.textmatch import Clause, ScanColumns, ScannedText, Scorer, Slot, StoredText, asked_of, slots_of

# Rows that may be asked for in this way; a longer page is ranked as a whole.
MOST_ROWS = 1000
# Documents named to the scan one by one; more are joined.
MOST_NAMED = 2000
# Documents whose scores set the threshold, as a multiple of the rows asked for.
TRIED = 4
# Bounds are compared with some room for rounding.
ROOM = 1 - 1e-9


@dataclass
class Runs:
    """One slot's runs: postings in each, and what none of them exceeds."""

    counts: list[int]
    bounds: list[float]

    def rest(self, depth: int) -> float:
        """Bound of the postings in runs above ``depth``."""
        return max(self.bounds[depth + 1 :], default=0.0)

    @property
    def last(self) -> int:
        return len(self.counts) - 1


class FirstPage:
    """A ranked text search whose first ``size`` rows are wanted.

    After :meth:`rows`, ``depths`` holds the last run read of each slot, ``read`` and ``total``
    the postings read and there, and ``scored`` the documents scored exactly (``None`` if they
    were too many to be named).
    """

    def __init__(self, source: StoredText, clauses: Sequence[Clause], where: Column | None, size: int):
        self.source, self.where, self.size = source, where, size
        self.clauses = asked_of(source, clauses)
        self.slots = slots_of(self.clauses)
        self.depths: list[int] = []
        self.read = self.total = 0
        self.scored: int | None = None

    # --- figures, a few rows each ---

    def _figures(self) -> None:
        spark = self.source.docs.sparkSession
        self.stats = spark.range(1).select(self.source.statistics(self.slots).alias("s")).first()["s"].asDict()
        rows = self.source.term_stats.where(reduce(or_, [self._selects(s) for s in self.slots]))
        columns = []
        for i, slot in enumerate(self.slots):
            here = self._selects(slot) & (F.col("df") > 0)
            worth = saturation(F.col("tf"), F.col("len"), self._mean(slot.field))
            columns.append(F.sum(F.when(here, F.col("df"))).alias(f"n{i}"))
            columns.append(F.max(F.when(here, worth)).alias(f"b{i}"))
        found = {row["run"]: row for row in rows.groupBy("run").agg(*columns).collect()}
        last = max(found, default=0)
        self.runs = []
        for i in range(len(self.slots)):
            values = [found.get(run) for run in range(last + 1)]
            counts = [(v[f"n{i}"] or 0) if v else 0 for v in values]
            self.runs.append(Runs(counts, [(v[f"b{i}"] or 0.0) if v else 0.0 for v in values]))
        self.total = sum(sum(runs.counts) for runs in self.runs)

    def _selects(self, slot: Slot) -> Column:
        return slot.selects(F.col("field"), F.col("term"))

    def _mean(self, field: str) -> float:
        n = self.stats[f"n_{field}"]
        return self.stats[f"words_{field}"] / n if n else 1.0

    def _weight(self, slot: Slot) -> float:
        n, df = self.stats[f"n_{slot.field}"] or 0, self.stats[f"df{self.slots.index(slot)}"] or 0
        return math.log(1 + (n - df + 0.5) / (df + 0.5))

    def _prepare(self) -> None:
        """Expressions for exact scores, built once: both passes use them."""
        self._scorer, self._pieces = Scorer(self.clauses), ScanColumns(self.slots)
        self._known = F.struct(*[F.lit(v).cast("long").alias(name) for name, v in self.stats.items()])

    # --- bounds ---

    def _clause_terms(self, clause: Clause) -> list[tuple[int, float]]:
        return [(self.slots.index(slot), self._weight(slot) * clause.boost) for slot in clause.slots]

    def _unseen(self, depths: Sequence[int]) -> float:
        """What no document reaches whose postings are all in unread runs."""
        rest = [runs.rest(depth) for runs, depth in zip(self.runs, depths)]
        total = 0.0
        for clause in self.clauses:
            terms = self._clause_terms(clause)
            if clause.kind == "any":
                total += sum(weight * rest[i] for i, weight in terms)
            else:
                # every word is needed, and one occurrence is worth no more than all of them
                total += sum(weight for _, weight in terms) * min(rest[i] for i, _ in terms)
        return total

    def _bounds(self, depths: Sequence[int]) -> tuple[Column, Column]:
        """Least and greatest score of a document from its worth ``w<i>`` in the runs read."""
        lower, upper = [F.lit(0.0)], [F.lit(0.0)]
        most = [F.coalesce(f"w{i}", F.lit(runs.rest(d))) for i, (runs, d) in enumerate(zip(self.runs, depths))]
        for clause in self.clauses:
            terms = self._clause_terms(clause)
            if clause.kind == "any":
                lower += [weight * F.coalesce(f"w{i}", F.lit(0.0)) for i, weight in terms]
                upper += [weight * most[i] for i, weight in terms]
            else:
                each = [most[i] for i, _ in terms]
                least = F.least(*each) if len(each) > 1 else each[0]
                upper.append(sum(weight for _, weight in terms) * least)
        return reduce(add, lower), reduce(add, upper)

    # --- passes over postings ---

    def _read(self, depths: Sequence[int]) -> DataFrame:
        """Documents with a posting in the runs up to ``depths``, with the worth of each slot."""
        field, term, run = F.col("field"), F.col("term"), F.col("run")
        rows = self.source.postings.where(
            reduce(or_, [slot.selects(field, term) & (run <= depth) for slot, depth in zip(self.slots, depths)])
        )
        worth = []
        for i, slot in enumerate(self.slots):
            mine = saturation(F.col("tf"), F.col("len"), self._mean(slot.field))
            worth.append(F.max(F.when(slot.selects(field, term), mine)).alias(f"w{i}"))
        return rows.groupBy("uid", "v").agg(*worth)

    def candidates(self, depths: Sequence[int], least: float | None) -> DataFrame:
        """``uid`` and ``lower`` of documents under ``where``, with a bound of ``least`` or more if given."""
        lower, upper = self._bounds(depths)
        found = self._read(depths)
        if least is not None:
            found = found.where(upper >= least)
        docs = self.source.docs if self.where is None else self.source.docs.where(self.where)
        return found.join(docs.select("uid", "v"), ["uid", "v"]).select("uid", lower.alias("lower"))

    def _exact(self, ids: Sequence[str] | DataFrame) -> DataFrame:
        """The named documents that match, scored from their texts."""
        docs = self.source.docs
        docs = docs.join(ids, "uid", "left_semi") if isinstance(ids, DataFrame) else docs.where(named(ids))
        found = ScannedText(self.source.public(docs)).positions(self.where, self.slots, self._pieces)
        return self._scorer(found, self._known)

    def _deeper(self, depths: list[int], least: float) -> list[int]:
        """Depths at which no unseen document reaches ``least``, read where it pays most."""
        depths = list(depths)
        while (bound := self._unseen(depths)) >= least * ROOM:
            best = None
            for i, runs in enumerate(self.runs):
                for depth in range(depths[i] + 1, runs.last + 1):
                    gain = bound - self._unseen([*depths[:i], depth, *depths[i + 1 :]])
                    share = gain / (1 + sum(runs.counts[depths[i] + 1 : depth + 1]))
                    if gain > 0 and (best is None or share > best[0]):
                        best = share, i, depth
            if best is None:
                return [runs.last for runs in self.runs]
            depths[best[1]] = best[2]
        return depths

    def rows(self) -> DataFrame | None:
        """Documents with their scores, the first ``size`` of all hits among them; ``None`` if
        nothing can be left out."""
        if not self.clauses or self.size > MOST_ROWS:
            return None
        self._figures()
        self._prepare()
        whole = [runs.last for runs in self.runs]
        depths, threshold = [0] * len(self.slots), None
        while threshold is None:
            if depths == whole:
                return None
            tried = self.candidates(depths, None).orderBy(F.desc("lower"), "uid").limit(TRIED * self.size)
            ids = [row["uid"] for row in tried.select("uid").collect()]
            scores = sorted((r["score"] for r in self._exact(ids).select("score").collect()), reverse=True) if ids else []
            if len(scores) >= self.size:
                threshold = scores[self.size - 1]
            else:
                depths = [min(depth + 1, runs.last) for depth, runs in zip(depths, self.runs)]
        depths = self._deeper([0] * len(self.slots), threshold)
        self.depths = depths
        self.read = sum(sum(runs.counts[: depth + 1]) for runs, depth in zip(self.runs, depths))
        if depths == whole:
            return None
        found = self.candidates(depths, threshold * ROOM).select("uid")
        ids = [row["uid"] for row in found.limit(MOST_NAMED + 1).collect()]
        if len(ids) > MOST_NAMED:
            return self._exact(found)
        self.scored = len(ids)
        return self._exact(ids)


def named(ids: Sequence[str]) -> Column:
    """Whether ``uid`` is one of the given ids, as one expression that reaches the scan."""
    escaped = [uid.replace("\\", "\\\\").replace("'", "\\'") for uid in ids]
    return F.expr("uid in ('" + "','".join(escaped) + "')") if escaped else F.lit(False)
