"""Full-text clauses: any-word match, sloppy phrase, phrase prefix, and their BM25 score.

A query is a handful of *slots*, one per distinct (field, word) or (field, word prefix). A
source gives, for each document, the positions of every slot as an array column; phrases
are then set operations on those arrays, so no clause needs a shuffle of its own. Word
positions come either from the text itself (:class:`ScannedText`, one narrow pass) or from
a stored postings table (:class:`StoredText`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.functions.text import query_tokens, strip_stars, tokens
from findlark.operators.postings import B, K1

SLOP = 2
TITLE = "Title"
MAIN_TEXT = "SearchableText"
TITLE_BOOST = 2.0
# columns of stored documents that are not attributes: part, hash bucket, word counts, distinct words
LAYOUT_COLUMNS = ("v", "bucket", "words", "terms")


@dataclass(frozen=True)
class Slot:
    """A word of a field, or all words of the field that start with ``term``."""

    field: str
    term: str
    prefix: bool = False

    def selects(self, field: Column, term: Column) -> Column:
        word = term.startswith(self.term) if self.prefix else term == self.term
        return (field == self.field) & word


@dataclass(frozen=True)
class Clause:
    """One scoring clause; ``kind`` is ``any``, ``phrase`` or ``prefix``."""

    kind: str
    field: str
    words: tuple[str, ...]
    boost: float = 1.0

    @property
    def slots(self) -> list[Slot]:
        """Slots in query order; ``any`` counts a repeated word once."""
        if self.kind == "any":
            return [Slot(self.field, word) for word in dict.fromkeys(self.words)]
        last = len(self.words) - 1
        return [
            Slot(self.field, word, self.kind == "prefix" and i == last)
            for i, word in enumerate(self.words)
        ]


def text_clauses(field: str, query: str | None) -> list[Clause]:
    """The clauses a text query on ``field`` asks for."""
    words = query_tokens(strip_stars(query))
    clauses = [Clause("phrase", field, words)]
    if field in (TITLE, MAIN_TEXT):
        clauses.append(Clause("prefix", TITLE, words, TITLE_BOOST))
    if field != TITLE:
        clauses.append(Clause("any", field, words))
    return clauses


def slots_of(clauses: Sequence[Clause]) -> list[Slot]:
    return list(dict.fromkeys(slot for clause in clauses for slot in clause.slots))


# --- sources of word positions ------------------------------------------------------------


class ScannedText:
    """Positions read from the text columns of the documents, without any index.

    ``partitions`` spreads the documents before they are analysed, for tables in so few files
    that cores would be idle; it costs a shuffle of what is read. 0 leaves the scan's splits.
    """

    def __init__(self, docs: DataFrame, key: str = "uid", partitions: int = 0):
        self.docs, self.key, self.partitions = docs, key, partitions

    @property
    def fields(self) -> list[str]:
        return self.docs.columns

    def _spread(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.partitions, self.key) if self.partitions else rows

    def public(self, rows: DataFrame) -> DataFrame:
        return rows

    def statistics(self, slots: Sequence[Slot]) -> Column:
        """One struct: documents and words per field, document count per slot."""
        fields = list(dict.fromkeys(slot.field for slot in slots))
        docs = self._spread(self.docs.select(self.key, *fields))
        words = docs.select(*[tokens(F.col(f)).alias(f"w{i}") for i, f in enumerate(fields)])
        figures = []
        for i, field in enumerate(fields):
            size = F.size(f"w{i}")
            figures.append(F.count_if(size > 0).alias(f"n_{field}"))
            figures.append(F.sum(size).alias(f"words_{field}"))
        for i, slot in enumerate(slots):
            column = F.col(f"w{fields.index(slot.field)}")
            figures.append(F.count_if(_any_word(column, slot)).alias(f"df{i}"))
        return words.agg(F.struct(*figures).alias("stats")).scalar()

    def positions(
        self, where: Column | None, slots: Sequence[Slot], pieces: ScanColumns | None = None
    ) -> DataFrame:
        """Documents under ``where`` that may match, with slot positions and field lengths."""
        pieces = pieces or ScanColumns(slots)
        docs = self.docs if where is None else self.docs.where(where)
        docs = self._spread(docs.where(pieces.likely))
        words = docs.select("*", *pieces.words)
        return words.select(*docs.columns, pieces.lengths, pieces.at)


class ScanColumns:
    """The expressions of one scan for slots; they fit any documents with these fields."""

    def __init__(self, slots: Sequence[Slot]):
        # a word can only occur where its letters do: spares the others the analysis
        likely = [F.lower(F.col(slot.field)).contains(slot.term) for slot in slots]
        self.likely = F.coalesce(reduce(or_, likely), F.lit(False))
        fields = list(dict.fromkeys(slot.field for slot in slots))
        self.words = [tokens(F.col(f)).alias(f"_w{i}") for i, f in enumerate(fields)]
        self.lengths = F.struct(*[F.size(f"_w{i}").alias(f) for i, f in enumerate(fields)]).alias("_len")
        self.at = F.struct(
            *[
                _word_positions(F.col(f"_w{fields.index(slot.field)}"), slot).alias(f"s{i}")
                for i, slot in enumerate(slots)
            ]
        ).alias("_at")


def _any_word(words: Column, slot: Slot) -> Column:
    if slot.prefix:
        return F.exists(words, lambda word: word.startswith(slot.term))
    return F.array_contains(words, slot.term)


def _word_positions(words: Column, slot: Slot) -> Column:
    def at(word: Column, i: Column) -> Column:
        return F.when(word.startswith(slot.term) if slot.prefix else word == slot.term, i)

    return F.array_compact(F.transform(words, at))


class StoredText:
    """Positions read from the tables that :mod:`findlark.plans.store` writes.

    Documents and postings carry the part ``v`` they were written in. ``docs`` has only
    current rows, so joining on it drops the postings of replaced ones; ``live`` does the
    same to rows that are not joined. Word counts are sums over all parts.
    """

    def __init__(
        self,
        docs: DataFrame,
        postings: DataFrame,
        term_stats: DataFrame,
        field_stats: DataFrame,
        live: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ):
        self.docs, self.live = docs, live
        self.postings, self.term_stats, self.field_stats = postings, term_stats, field_stats

    @property
    def fields(self) -> list[str]:
        return self.docs.schema["words"].dataType.names

    def public(self, rows: DataFrame) -> DataFrame:
        """Rows without the columns of the storage layout."""
        return rows.drop(*LAYOUT_COLUMNS)

    def _wanted(self, table: DataFrame, slots: Sequence[Slot]) -> DataFrame:
        """Rows of the wanted words only: the condition reaches the Parquet scan."""
        return table.where(reduce(or_, [s.selects(F.col("field"), F.col("term")) for s in slots]))

    def statistics(self, slots: Sequence[Slot]) -> Column:
        fields = list(dict.fromkeys(slot.field for slot in slots))
        exact = [slot for slot in slots if not slot.prefix]
        open_ended = [slot for slot in slots if slot.prefix]
        field, term = F.col("field"), F.col("term")
        zero = F.lit(0).cast("long")
        parts = [
            self.field_stats.where(field.isin(*fields)).select(
                "field", F.lit("").alias("term"), "n", "words", zero.alias("df")
            )
        ]
        if exact:
            counts = self._wanted(self.term_stats, exact)
            parts.append(counts.select("field", "term", zero.alias("n"), zero.alias("words"), "df"))
        figures = []
        for name in fields:
            figures.append(F.sum(F.when(field == name, F.col("n"))).alias(f"n_{name}"))
            figures.append(F.sum(F.when(field == name, F.col("words"))).alias(f"words_{name}"))
        for i, slot in enumerate(slots):
            if not slot.prefix:
                figures.append(
                    F.coalesce(
                        F.sum(F.when(slot.selects(field, term), F.col("df"))), F.lit(0)
                    ).alias(f"df{i}")
                )
        stats = reduce(DataFrame.unionByName, parts).agg(F.struct(*figures).alias("stats")).scalar()
        if not open_ended:
            return stats
        # documents holding any word of the prefix: not a sum over words
        per_doc = self._wanted(self.postings, open_ended).groupBy("uid", "v")
        flags = per_doc.agg(
            *[
                F.bool_or(slot.selects(field, term)).alias(f"df{i}")
                for i, slot in enumerate(slots)
                if slot.prefix
            ]
        )
        counts = self.live(flags).agg(
            F.struct(
                *[F.count_if(F.col(f"df{i}")).alias(f"df{i}") for i, s in enumerate(slots) if s.prefix]
            ).alias("stats")
        ).scalar()
        for i, slot in enumerate(slots):
            if slot.prefix:
                stats = stats.withField(f"df{i}", counts[f"df{i}"])
        return stats

    def positions(self, where: Column | None, slots: Sequence[Slot]) -> DataFrame:
        field, term = F.col("field"), F.col("term")
        per_doc = self._wanted(self.postings, slots).groupBy("uid", "v")
        columns = []
        for i, slot in enumerate(slots):
            mine = F.when(slot.selects(field, term), F.col("positions"))
            # an exact word has one row per document; a prefix has one per word it covers
            got = F.flatten(F.collect_list(mine)) if slot.prefix else F.first(mine, ignorenulls=True)
            columns.append(F.coalesce(got, F.array().cast("array<int>")).alias(f"s{i}"))
        found = per_doc.agg(*columns)
        found = found.select("uid", "v", F.struct(*[f"s{i}" for i in range(len(slots))]).alias("_at"))
        docs = self.docs if where is None else self.docs.where(where)
        fields = list(dict.fromkeys(slot.field for slot in slots))
        lengths = F.struct(*[F.col(f"words.{name}").alias(name) for name in fields])
        return self.public(docs.withColumn("_len", lengths).join(found, ["uid", "v"]))


# --- clauses over positions ---------------------------------------------------------------


def _shift(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by) if by else positions


def _aligned(at: list[Column], slack: int) -> Column:
    """Starts ``m`` such that every slot ``i`` has a position in ``[m + i, m + i + slack]``."""
    reach = [
        reduce(F.array_union, [_shift(p, i + d) for d in range(slack + 1)]) for i, p in enumerate(at)
    ]
    return reduce(F.array_intersect, reach)


def _free_after(last: Column, low: Column, high: Column):
    return lambda p: (p > last) & (p >= low) & (p <= high)


def _distinct_from(start: Column, at: list[Column], words: Sequence[object], slack: int) -> Column:
    """Whether repeated words can take different positions from ``start`` on.

    The windows of one word all have the same width, so taking the first free position in
    window order finds an assignment whenever there is one.
    """
    checks = []
    for word in dict.fromkeys(words):
        turns = [i for i, other in enumerate(words) if other == word]
        if len(turns) < 2:
            continue
        positions = at[turns[0]]
        last = F.lit(-1)
        for i in turns:
            free = F.filter(positions, _free_after(last, start + i, start + i + slack))
            # no free position: an unreachable one, so that later turns fail too
            last = F.coalesce(F.array_min(free), F.lit(2**31 - 1))
        checks.append(last < F.lit(2**31 - 1))
    return reduce(and_, checks)


def _distinct_starts(at: list[Column], words: Sequence[object], slack: int):
    return lambda start: _distinct_from(start, at, words, slack)


def spread(at: list[Column], words: Sequence[object], slop: int = SLOP) -> Column:
    """Smallest slack at which the words line up as a phrase; null if none up to ``slop``."""
    if not at:
        return F.lit(None).cast("int")
    repeated = len(set(words)) < len(words)
    result = F.lit(None).cast("int")
    for slack in range(slop, -1, -1):
        starts = _aligned(at, slack)
        if repeated:
            starts = F.filter(starts, _distinct_starts(at, words, slack))
        result = F.when(F.size(starts) > 0, F.lit(slack)).otherwise(result)
    every = reduce(and_, [F.size(positions) > 0 for positions in at])
    return F.when(every, result)


def _facts(clauses: Sequence[Clause], slots: list[Slot]) -> Column:
    """What scoring needs to know of a document: slot counts and the spread of each phrase."""
    facts = [F.size(F.col(f"_at.s{i}")).alias(f"tf{i}") for i in range(len(slots))]
    for c, clause in enumerate(clauses):
        if clause.kind != "any":
            mine = clause.slots
            at = [F.col(f"_at.s{slots.index(slot)}") for slot in mine]
            slop = SLOP if clause.kind == "phrase" else 0
            facts.append(spread(at, mine, slop).alias(f"spread{c}"))
    return F.struct(*facts)


def _holds(facts: Column, c: int, clause: Clause, slots: list[Slot]) -> Column:
    if not clause.words:
        return F.lit(False)
    if clause.kind == "any":
        return reduce(or_, [facts[f"tf{slots.index(slot)}"] > 0 for slot in clause.slots])
    return facts[f"spread{c}"].isNotNull()


def _score(c: int, clause: Clause, slots: list[Slot], stats: Column) -> Column:
    """BM25 of one clause (Robertson & Zaragoza 2009)."""
    facts = F.col("_facts")
    n = stats[f"n_{clause.field}"]
    mean = stats[f"words_{clause.field}"] / n
    norm = K1 * (1 - B + B * F.col(f"_len.{clause.field}") / mean)

    def weight(slot: Slot) -> Column:
        df = stats[f"df{slots.index(slot)}"]
        return F.log(1 + (n - df + 0.5) / (df + 0.5))

    def saturated(frequency: Column) -> Column:
        return frequency * (K1 + 1) / (frequency + norm)

    if clause.kind == "any":
        parts = [weight(s) * saturated(facts[f"tf{slots.index(s)}"]) for s in clause.slots]
        return reduce(add, parts) * clause.boost
    weights = reduce(add, [weight(slot) for slot in clause.slots])
    return weights * saturated(1 / (1 + facts[f"spread{c}"])) * clause.boost


def asked_of(source: ScannedText | StoredText, clauses: Sequence[Clause]) -> list[Clause]:
    """The clauses that can match: those with words, on a field that the rows have."""
    return [clause for clause in clauses if clause.words and clause.field in source.fields]


def match_text(
    source: ScannedText | StoredText,
    clauses: Sequence[Clause],
    where: Column | None = None,
    stats: Column | None = None,
) -> DataFrame:
    """Documents under ``where`` for which at least one clause holds, with their ``score``.

    Word and document counts come from the whole field, not only from the filtered rows, or from
    ``stats`` where they are known already.
    """
    clauses = asked_of(source, clauses)
    if not clauses:
        return source.public(source.docs.where(F.lit(False))).withColumn("score", F.lit(0.0))
    scorer = Scorer(clauses)
    found = source.positions(where, scorer.slots)
    return scorer(found, source.statistics(scorer.slots) if stats is None else stats)


class Scorer:
    """The expressions that decide on and score documents with positions; they fit any of them."""

    def __init__(self, clauses: Sequence[Clause]):
        self.slots = slots = slots_of(clauses)
        # a generator keeps the optimiser from copying the position expressions into a filter
        self.facts = F.filter(
            F.array(_facts(clauses, slots)),
            lambda f: reduce(or_, [_holds(f, c, clause, slots) for c, clause in enumerate(clauses)]),
        )
        score = [
            F.when(
                _holds(F.col("_facts"), c, clause, slots), _score(c, clause, slots, F.col("_stats"))
            ).otherwise(0.0)
            for c, clause in enumerate(clauses)
        ]
        self.score = reduce(add, score).alias("score")

    def __call__(self, found: DataFrame, stats: Column) -> DataFrame:
        kept = [name for name in found.columns if name not in ("_at", "_len")]
        found = found.select(*kept, "_len", F.explode(self.facts).alias("_facts"))
        return found.withColumn("_stats", stats).select(*kept, self.score)


def highlight_words(clauses: Sequence[Clause], field: str = MAIN_TEXT) -> list[Slot]:
    """Words the clauses of ``field`` look for."""
    return slots_of([clause for clause in clauses if clause.field == field])
