"""Highlighted extracts of the matched text, as row-wise expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.functions.text import FRAGMENT_CHARS, fragments, pieces
from findlark.operators.textmatch import Slot

SEPARATOR = " ... "
EXTRACT = "extract"


def _is_match(word: Column, words: Sequence[Slot]) -> Column:
    low = F.lower(word)
    exact = [slot.term for slot in words if not slot.prefix]
    tests = [low.isin(*exact)] if exact else []
    tests += [low.startswith(slot.term) for slot in words if slot.prefix]
    return reduce(or_, tests)


def highlight_fragments(
    text: Column, words: Sequence[Slot], pre: str, post: str, count: int = 5, chars: int = FRAGMENT_CHARS
) -> Column:
    """The ``count`` fragments with most matches, in descending match count, matches wrapped.

    Each is ``struct<order, matches, fragment>``; ``order`` is its place in the text.
    """
    if not words:
        return F.array().cast("array<struct<order:int,matches:int,fragment:string>>")

    def mark(run: Column, i: Column) -> Column:
        parts = pieces(run)
        marked = F.transform(
            parts,
            lambda part: F.when(
                _is_match(part, words), F.concat(F.lit(pre), part, F.lit(post))
            ).otherwise(part),
        )
        return F.struct(
            i.alias("order"),
            F.size(F.filter(parts, lambda part: _is_match(part, words))).alias("matches"),
            F.array_join(marked, "").alias("fragment"),
        )

    hits = F.filter(F.transform(fragments(text, chars), mark), lambda f: f["matches"] > 0)

    def by_rank(a: Column, b: Column) -> Column:
        fewer = a["matches"] < b["matches"]
        later = (a["matches"] == b["matches"]) & (a["order"] > b["order"])
        return F.when(fewer | later, 1).otherwise(-1)

    return F.slice(F.array_sort(hits, by_rank), 1, count)


def join_fragments(found: Column, threshold: int) -> Column:
    """Fragments joined up to ``threshold`` characters, tags included; the first always stays."""
    texts = F.transform(found, lambda f: f["fragment"])
    start = F.struct(F.lit(0).alias("length"), F.array().cast("array<string>").alias("kept"))

    def take(state: Column, text: Column) -> Column:
        length = state["length"] + F.length(text)
        fits = (F.size(state["kept"]) == 0) | (length <= threshold)
        # lengths only grow, so nothing is kept after the first that does not fit
        return F.struct(
            length.alias("length"),
            F.when(fits, F.array_append(state["kept"], text)).otherwise(state["kept"]).alias("kept"),
        )

    return F.aggregate(texts, start, take, lambda state: F.array_join(state["kept"], SEPARATOR))


def describe_hits(
    hits: DataFrame,
    words: Sequence[Slot],
    *,
    pre: str,
    post: str,
    threshold: int,
    count: int = 5,
    chars: int = FRAGMENT_CHARS,
    text: str = "SearchableText",
    description: str = "Description",
) -> DataFrame:
    """Replace the description by the highlighted extract where there is one.

    The extract itself, null without one, is in ``extract``.
    """
    found = highlight_fragments(F.col(text), words, pre, post, count, chars)
    plain = F.col(description) if description in hits.columns else F.lit(None).cast("string")
    hits = hits.withColumn(EXTRACT, F.nullif(join_fragments(found, threshold), F.lit("")))
    return hits.withColumn(description, F.coalesce(EXTRACT, plain))
