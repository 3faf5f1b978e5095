"""Quality rules: counts of a text, and divergence of its histograms from its language's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.config import materialise
from findlark.llm.common import words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# share of words in repeated windows above which a text fails, per cent
MAX_REPEATED = 50
# Jensen-Shannon distances (0 to 1) above which a text is unlike its language
MAX_CHARACTERS = 0.28
MAX_WORDS = 0.75
# histogram shares enter the references as whole millionths, so sums do not depend on their order
UNIT = 1_000_000

# Common words of four languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "with", "as", "be"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
CODES = "0abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_flags(order: Column, same) -> Column:
    """Word positions of 3-word windows that occur twice or more, ascending.

    ``order`` holds the windows so that equal ones are neighbours; ``same(k)`` tells whether
    elements k and k+1 are equal.
    """
    last = F.size(order) - 1
    hit = F.filter(
        F.sequence(F.lit(0), last), lambda k: ((k < last) & same(k)) | ((k > 0) & same(F.greatest(k - 1, F.lit(0))))
    )
    return hit


def covered(starts: Column) -> Column:
    """Words in the 3-word windows that begin at the given ascending positions."""
    rest = F.size(starts) - 1
    gaps = F.zip_with(
        F.slice(starts, 1, F.greatest(rest, F.lit(0))), F.slice(starts, 2, F.greatest(rest, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(3).cast("long")),
    )
    return F.when(F.size(starts) == 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(gaps, F.lit(3).cast("long"), lambda total, gap: total + gap)
    )


POSITION_BITS = 20


def repeated_words(w: Column) -> Column:
    """Number of words in 3-word windows that occur at least twice in the word array ``w``.

    Windows are sorted as numbers: the upper bits of a hash, then the position. Neighbours with
    equal hash bits are compared word by word; if any two differ, or the text has more words
    than the position bits hold, the windows themselves are sorted instead. Exact either way.
    """
    mask = (1 << POSITION_BITS) - 1
    last = F.size(w) - 3

    def word(i):
        return F.get(w, i.cast("int"))

    def packed(i):
        hashed = F.xxhash64(word(i), word(i + 1), word(i + 2))
        return hashed.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))

    def at(order, k):
        return F.get(order, k.cast("int"))

    def fast(order):
        def same(k):
            return F.shiftrightunsigned(at(order, k).bitwiseXOR(at(order, k + 1)), POSITION_BITS) == 0

        def position(k):
            return at(order, k).bitwiseAND(F.lit(mask))

        def differ(k):
            p, q = position(k), position(k + 1)
            return ~((word(p) == word(q)) & (word(p + 1) == word(q + 1)) & (word(p + 2) == word(q + 2)))

        clash = F.exists(F.sequence(F.lit(0), F.size(order) - 2), lambda k: same(k) & differ(k))
        hits = F.sort_array(F.transform(repeat_flags(order, same), position))
        return F.when(F.size(order) == 1, F.lit(0).cast("long")).when(~clash, let(hits, covered))

    def exact(order):
        def same(k):
            a, b = at(order, k), at(order, k + 1)
            return (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])

        hits = F.sort_array(F.transform(repeat_flags(order, same), lambda k: at(order, k)["i"].cast("long")))
        return let(hits, covered)

    seq = F.sequence(F.lit(0), last)
    by_hash = let(F.sort_array(F.transform(seq, packed)), fast)
    as_rows = F.transform(
        seq, lambda i: F.struct(word(i).alias("a"), word(i + 1).alias("b"), word(i + 2).alias("c"), i.alias("i"))
    )
    by_word = let(F.sort_array(as_rows), exact)
    short = F.when(F.size(w) <= 1 << POSITION_BITS, by_hash)
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(F.coalesce(short, by_word))


def character_classes(text: Column) -> Column:
    """Characters that are a-z, A-Z, other letters, digits, white space, punctuation, and the rest."""
    patterns = [r"[a-z]+", r"[A-Z]+", r"\p{L}+", r"\p{N}+", r"\s+", r"""[.,;:!?'"()-]+"""]

    def count(left, rest, done):
        if not rest:
            return F.array(*done, F.length(left).cast("long"))
        return let(
            F.regexp_replace(left, rest[0], ""),
            lambda less: count(less, rest[1:], [*done, (F.length(left) - F.length(less)).cast("long")]),
        )

    return let(text, lambda t: count(t, patterns, []))


def common_words(w: Column, lang: Column, common: Mapping[str, Sequence[str]]) -> Column:
    """Counts of the language's common words, then of all others; null for a language without list."""
    listed = F.lit(None).cast("array<string>")
    for name, values in common.items():
        listed = F.when(lang == name, F.array(*[F.lit(v) for v in values])).otherwise(listed)
    size = max(map(len, common.values()))

    def counts(codes):
        one = [F.length(codes) - F.length(F.replace(codes, F.lit(c))) for c in CODES[1 : size + 1] + CODES[0]]
        return F.array(*[c.cast("long") for c in one])

    def coded(values):
        pick = F.transform(w, lambda x: F.substring(F.lit(CODES), F.array_position(values, x).cast("int") + 1, F.lit(1)))
        return let(F.array_join(pick, ""), counts)

    return F.when(listed.isNotNull(), let(listed, coded))


def shares(counts: Column) -> Column:
    """Counts as whole millionths of their sum."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return let(total, lambda t: F.transform(counts, lambda c: F.when(t > 0, F.floor(c * UNIT / t)).otherwise(0)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two histograms given as counts."""
    total = F.lit(0.0)
    sums = F.struct(
        F.aggregate(p, total, lambda a, b: a + b).alias("p"), F.aggregate(q, total, lambda a, b: a + b).alias("q")
    )

    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def both(s):
        terms = F.zip_with(
            p, q, lambda a, b: let(
                F.struct((a / s["p"]).alias("a"), (b / s["q"]).alias("b")),
                lambda v: part(v["a"], (v["a"] + v["b"]) / 2) + part(v["b"], (v["a"] + v["b"]) / 2),
            )
        )
        value = F.sqrt(F.greatest(F.aggregate(terms, total, lambda a, b: a + b) / 2, total))
        return F.when((s["p"] > 0) & (s["q"] > 0), value)

    return let(sums, both)


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_characters: float = MAX_CHARACTERS,
    max_words: float = MAX_WORDS,
    common: Mapping[str, Sequence[str]] = COMMON,
) -> DataFrame:
    """Counts and verdict of every document.

    One pass over the texts makes a narrow table; language references are the mean histograms
    (seven classes of characters; each language's common words and the rest) over all documents
    of a language with at least ``min_words`` words. A document is kept if it passes the counts
    and neither distance to its language's reference exceeds its limit. Documents shorter than
    ``min_words`` fail already; a language without reference (null too) leaves the counts to
    decide, and one without a list of common words the characters alone.

    Null text has no words. Repeated rows and ids are judged one by one, each as itself; no rows
    give no rows; other columns are left out. JVM functions only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")

    def measured(w):
        shown = F.filter(lines, lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(shown, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            character_classes(text).alias("characters"),
            common_words(w, F.col("lang"), common).alias("common"),
        )

    rows = docs.select("doc_id", "lang", let(words(F.col("text")), measured).alias("m"))
    rows = materialise(rows.select("doc_id", "lang", "m.*"), "quality")
    size = len(CODES)
    sums = [
        F.sum(F.get(shares(F.col(name)), F.lit(k))).alias(f"{name}_{k}")
        for name, count in (("characters", 7), ("common", max(map(len, common.values())) + 1))
        for k in range(min(count, size))
    ]
    # one row per language
    references = rows.where((F.col("n_words") >= min_words) & F.col("lang").isNotNull()).groupBy("lang").agg(*sums)
    references = references.select(
        F.col("lang").alias("_lang"),
        *[
            F.array(*[c for c in references.columns if c.startswith(f"{name}_")]).alias(f"ref_{name}")
            for name in ("characters", "common")
        ],
    )
    joined = rows.join(references, F.col("lang") == F.col("_lang"), "left")
    joined = joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))).alias("base_failed"),
        distance(F.col("characters"), F.col("ref_characters")).alias("character_distance"),
        distance(F.col("common"), F.col("ref_common")).alias("word_distance"),
    )
    near = (F.coalesce("character_distance", F.lit(0.0)) <= max_characters) & (
        F.coalesce("word_distance", F.lit(0.0)) <= max_words
    )
    return joined.withColumn("kept", ~F.col("base_failed") & near)


def _listed(common: Mapping[str, Sequence[str]]) -> str:
    cases = " ".join(
        "WHEN '{}' THEN [{}]".format(name, ", ".join(f"'{v}'" for v in values)) for name, values in common.items()
    )
    return f"CASE lang {cases} END"


def _distance(p: str, q: str) -> str:
    """The distance of two lists in SQL."""
    pairs = f"list_transform(range(1, len({p}) + 1), lambda k: {{'a': {p}[k] / list_sum({p}), 'b': {q}[k] / list_sum({q})}})"
    terms = " + ".join(f"CASE WHEN z.{x} > 0 THEN z.{x} * log2(z.{x} / ((z.a + z.b) / 2)) ELSE 0 END" for x in "ab")
    value = f"sqrt(greatest(list_sum(list_transform({pairs}, lambda z: {terms})) / 2, 0))"
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN {value} END"


def _shares(name: str, size: int) -> str:
    total = f"list_sum({name})"
    each = [f"sum(CASE WHEN {total} > 0 THEN floor({name}[{k}] * 1000000 / {total}) ELSE 0 END)" for k in range(1, size + 1)]
    return f"[{', '.join(each)}]"


BASE_SQL = """
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
e AS (
  SELECT doc_id, lang, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, w,
         row_number() OVER () AS row
  FROM d),
win AS (
  SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM e, unnest(range(1, len(w) - 1)) r(i)),
twice AS (SELECT row, i FROM win QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
rep AS (SELECT row, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(3) s(k) GROUP BY row),
base AS (
  SELECT row, doc_id, lang, t, w, n_words, word_chars, n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed
  FROM e LEFT JOIN rep USING (row))"""

_CLASSES = ["[a-z]+", "[A-Z]+", r"\p{L}+", r"\p{N}+", r"[ \t\n\x0b\f\r]+", """[.,;:!?''"()-]+"""]


def sql() -> str:
    """The whole result in SQL: base counts, histograms, references and distances."""
    left = ["t"]
    for pattern in _CLASSES:
        left.append(f"regexp_replace({left[-1]}, '{pattern}', '', 'g')")
    counts = ", ".join([*(f"length({a}) - length({b})" for a, b in zip(left, left[1:])), f"length({left[-1]})"])
    size = max(map(len, COMMON.values())) + 1
    at = "list_transform(w, lambda x: coalesce(list_position(listed, x), 0))"
    common = ", ".join(f"len(list_filter(spots, lambda x: x = {k}))" for k in [*range(1, size), 0])
    return f"""{BASE_SQL},
listed AS (SELECT *, {_listed(COMMON)} AS listed FROM base),
placed AS (SELECT *, {at} AS spots FROM listed),
hist AS (
  SELECT * EXCLUDE (t, w, spots), [{counts}] AS ch, CASE WHEN listed IS NOT NULL THEN [{common}] END AS co FROM placed),
refs AS (
  SELECT lang, {_shares("ch", 7)} AS rch, {_shares("co", size)} AS rco
  FROM hist WHERE n_words >= {MIN_WORDS} AND lang IS NOT NULL GROUP BY lang),
far AS (SELECT hist.*, {_distance("ch", "rch")} AS dch, {_distance("co", "rco")} AS dco FROM hist LEFT JOIN refs USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(dch, 0) <= {MAX_CHARACTERS} AND coalesce(dco, 0) <= {MAX_WORDS} AS kept
FROM far"""
