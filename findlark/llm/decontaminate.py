"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.config import materialise
from findlark.llm.common import GAP
from findlark.llm.quality import let

WINDOW = 5
MIN_SHARE = 0.8
MIN_CONSISTENT = 0.8

UNITS = (
    "mm cm km m kg g mg lb oz l ml s ms min h hours hour minutes minute seconds second days day weeks week months "
    "month years year miles mile feet foot inches inch meters metres dollars dollar euros euro cents percent degrees"
).split()

NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()

MARK = "\u0001"
NAME_MARK = MARK + "n"
# A capitalised word, then a number in figures or words, then a unit after a number. The mark and
# a letter for the kind are put before the word, so a token keeps what its placeholder stands for.
NAME = r"(?<![\p{L}\p{N}])(\p{Lu}\p{Ll}+)(?!\p{L})"
NUMBER = rf"(?<![\p{{L}}\p{{N}}])(?:\x01n)?([0-9][0-9.,]*|(?i:{'|'.join(NUMBERS)})(?![\p{{L}}\p{{N}}]))"
UNIT = (
    rf"(\x01d[\p{{L}}0-9.,]*[\x20\x09-\x0D]?)((?i:{'|'.join(sorted(UNITS, key=len, reverse=True))}))(?![\p{{L}}\p{{N}}])"
)
OTHER = r"[^\p{L}\p{N}\x01\x20\x09-\x0D]+"
# Readings of a text: every capitalised word is part of a name; no word is; short items as they are.
NAMED, PLAIN, WHOLE = 0, 1, 2


def tokens(text: Column) -> Column:
    """Template tokens of a text: lower-case words, and marked names, numbers and units."""
    marked = F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" ")), NAME, NAME_MARK + "$1")
    marked = F.regexp_replace(marked, NUMBER, MARK + "d$1")
    marked = F.regexp_replace(marked, UNIT, "$1 " + MARK + "u$2")
    plain = F.lower(F.regexp_replace(marked, OTHER, " "))
    return F.filter(F.split(plain, GAP), lambda t: t != "")


def named(of: Column) -> Column:
    """Runs of capitalised words as one name each, that of their last word."""
    mark = F.lit(NAME_MARK)
    return F.filter(of, lambda t, i: ~F.startswith(t, mark) | ~F.coalesce(F.startswith(F.get(of, i + 1), mark), F.lit(False)))


def unnamed(of: Column) -> Column:
    """Capitalised words as any others."""
    return F.transform(of, lambda t: F.when(F.startswith(t, F.lit(NAME_MARK)), F.substr(t, F.lit(3))).otherwise(t))


def bare(of: Column) -> Column:
    """All tokens as they are, numbers and units too."""
    return F.transform(of, lambda t: F.when(F.startswith(t, F.lit(MARK)), F.substr(t, F.lit(3))).otherwise(t))


def kinds(of: Column) -> Column:
    """Tokens with values left out: what two fillings of one template have in common."""
    return F.transform(of, lambda t: F.when(F.startswith(t, F.lit(MARK)), F.substring(t, 1, 2)).otherwise(t))


def windows(of: Column, size: int, reading: int) -> Column:
    """Hashes of all runs of ``size`` tokens, values left out, by first token; other readings hash
    otherwise."""

    def hashes(k):
        def one(i):
            return F.xxhash64(F.lit(reading * 100 + size), *[F.get(k, i + j) for j in range(size)])

        some = F.transform(F.sequence(F.lit(0), F.size(k) - size), one)
        return F.when(F.size(k) < size, F.array().cast("array<bigint>")).otherwise(some)

    return let(kinds(of), hashes)


def readings(rows: DataFrame, key: str, window: int, short: list[int], own_size: bool) -> DataFrame:
    """``key, reading, t, w``: tokens and windows of every reading of ``text``, one row each.

    Reading ``WHOLE`` has windows of the sizes ``short``; with ``own_size`` it is a text shorter than
    a window, taken whole.
    """

    def each(t: Column) -> Column:
        def cut(reading: int):
            return lambda x: F.struct(
                F.lit(reading).alias("reading"), x.alias("t"), windows(x, window, reading).alias("w")
            )

        found = [let(named(t), cut(NAMED)), let(unnamed(t), cut(PLAIN))]
        if short:

            def whole(x: Column) -> Column:
                sized = [
                    F.when((F.size(x) == n) if own_size else F.size(x) >= n, windows(x, n, WHOLE)).otherwise(F.array().cast("array<bigint>"))
                    for n in short
                ]
                return F.struct(F.lit(WHOLE).alias("reading"), x.alias("t"), F.concat(*sized).alias("w"))

            found.append(let(bare(t), whole))
        return F.array(*found)

    # outer: for an inner one Spark asks every scanned text first whether there is anything to explode
    return rows.select(key, F.explode_outer(let(tokens(F.col("text")), each)).alias("r")).select(key, "r.*")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
    min_consistent: float = MIN_CONSISTENT,
) -> DataFrame:
    """Documents that hold a benchmark item, as they are or with other names and numbers.

    Names (capitalised words, a run of them is one), numbers (in figures or words) and units become
    typed placeholders. A second reading takes capitalised words as any others, so that copies in
    other case count; an item shorter than a window is looked for whole, as it is but for case. In
    what follows each reading stands for itself, and the best one counts. Windows of ``window`` tokens are joined
    by hash; a document with ``min_share`` of an item's distinct windows is a candidate. For
    candidates, the values that one item value meets in the matched windows are compared: the
    share of slots in which it meets its most frequent partner is the consistency, 1 without
    slots, and must reach ``min_consistent`` in the document or in one occurrence of the item:
    the windows that lie at about one distance from the item's, with ``min_share`` of them. An
    item that was filled in anew maps each value to one other, in each filling anew; windows that
    match by chance do not. ``consistency`` is the best of these.

    Windows of the items are written first; Spark broadcasts them while that file is below its
    limit and shuffles hashes otherwise. Matches are combined per document before the shuffle.

    Returns ``doc_id, item_id, n_windows, n_shared, share, consistency``, one row per pair. Null
    and empty texts hold nothing, an item without a token is not looked for; rows that share an id are one document, repeated items are one; no rows give no rows; other
    columns are left out. JVM functions only.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text")
    counts = items.select(F.size(tokens(F.col("text"))).alias("n")).where(f"n between 1 and {window - 1}")
    # at most one number for each size below a window's
    short = sorted(row["n"] for row in counts.distinct().collect())
    items = readings(items, "item_id", window, short, own_size=True)
    known = items.select("item_id", "reading", F.explode_outer("w").alias("hash")).where("hash is not null").distinct()
    known = materialise(known, "item-windows")
    sizes = known.groupBy("item_id", "reading").agg(F.count("*").alias("n_windows"))

    own = readings(docs.select("doc_id", "text"), "doc_id", window, short, own_size=False)
    own = own.select("doc_id", F.explode_outer(F.array_distinct("w")).alias("hash"))
    hits = own.where("hash is not null").join(known, "hash")
    shared = hits.groupBy("doc_id", "item_id", "reading").agg(F.count_distinct("hash").alias("n_shared"))
    found = shared.join(sizes, ["item_id", "reading"]).withColumn("share", F.col("n_shared") / F.col("n_windows"))
    found = materialise(found.where(F.col("share") >= min_share), "leak-candidates")

    # values are compared for candidates only
    ids = found.select(F.col("doc_id").alias("_doc")).distinct()
    own = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    own = materialise(readings(own, "doc_id", window, short, own_size=False), "leak-tokens")
    items = items.withColumn("n", F.size("t"))
    pairs = found.select(F.col("doc_id").alias("_doc"), "item_id", "reading", "n_windows")
    of_doc = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_reading") == F.col("reading"))
    pair, item = ["_doc", "item_id", "reading"], ["item_id", "reading"]

    # windows of one occurrence have about the same distance between document and item
    item_at = items.select(*item, "n", F.posexplode("w").alias("i", "hash"))
    doc_at = own.select("doc_id", F.col("reading").alias("_reading"), F.posexplode("w").alias("j", "_hash"))
    near = pairs.join(item_at, item).join(doc_at, of_doc & (F.col("hash") == F.col("_hash")))
    near = near.select(*pair, "n_windows", "hash", F.explode(occurrences()).alias("o"))
    held = near.groupBy(*pair, "n_windows", "o").agg(F.count_distinct("hash").alias("seen"))
    whole = F.col("o.kind") == 0
    held = held.where(whole | (F.col("seen") / F.col("n_windows") >= min_share)).select(*pair, "o")

    slots = places(items, [*item, "n"], window).withColumnsRenamed({"value": "item_value", "at": "i"})
    met = places(own, ["doc_id", "reading"], window)
    met = met.withColumnsRenamed({"at": "j", "hash": "_hash", "place": "_place", "reading": "_reading"})
    same = of_doc & (F.col("_hash") == F.col("hash")) & (F.col("_place") == F.col("place"))
    counted = pairs.join(slots, item).join(met, same)
    counted = counted.select(*pair, "item_value", "value", F.explode(occurrences()).alias("o"))
    counted = counted.groupBy(*pair, "o", "item_value", "value").count()
    best = counted.groupBy(*pair, "o", "item_value").agg(F.max("count").alias("most"), F.sum("count").alias("all"))
    agreed = best.groupBy(
        F.col("_doc").alias("_d"), F.col("item_id").alias("_i"), F.col("reading").alias("_r"), F.col("o").alias("_o")
    ).agg((F.sum("most") / F.sum("all")).alias("consistency"))
    one = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("item_id") == F.col("_i")) & (F.col("reading") == F.col("_r"))
    each = held.join(agreed, one & (F.col("o") == F.col("_o")), "left")
    agreed = each.groupBy("_doc", F.col("item_id").alias("_item"), F.col("reading").alias("_of")).agg(
        F.max(F.coalesce("consistency", F.lit(1.0))).alias("consistency")
    )
    of_pair = (F.col("item_id") == F.col("_item")) & (F.col("reading") == F.col("_of"))
    result = found.join(agreed, F.col("doc_id").eqNullSafe(F.col("_doc")) & of_pair, "left")
    result = result.withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
    result = result.where(F.col("consistency") >= min_consistent)
    figures = F.struct("share", "consistency", "n_windows", "n_shared")
    return result.groupBy("doc_id", "item_id").agg(F.max(figures).alias("b")).select(
        "doc_id", "item_id", "b.n_windows", "b.n_shared", "b.share", "b.consistency"
    )


def occurrences() -> Column:
    """The groups a match at item place ``i`` and document place ``j`` belongs to: the whole
    document, its distance, and two rows of bins as long as the item, half a bin apart."""
    apart, n = (F.col("j") - F.col("i")).cast("long"), F.col("n")
    bins = [F.lit(0).cast("long"), apart, F.floor(apart / n), F.floor(apart / n + F.lit(0.5))]
    return F.array(*[F.struct(F.lit(k).alias("kind"), b.alias("bin")) for k, b in enumerate(bins)])


def places(rows: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Values of the slots of every window: ``keys, at, hash, place, value``."""
    at = rows.select(*keys, "t", F.posexplode("w").alias("at", "hash"))
    cut = at.select(
        *keys, "at", "hash", F.posexplode(F.slice("t", F.col("at") + 1, F.lit(window))).alias("place", "token")
    )
    cut = cut.where(F.startswith("token", F.lit(MARK)))
    return cut.select(*keys, "at", "hash", "place", F.expr("substring(token, 2)").alias("value"))
