"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlark.llm.quality import let

# Characters of an account number, by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
COUNTRIES = "|".join(" ".join(IBAN_LENGTHS.values()).split())


def iban() -> str:
    """Account numbers as long as their country says; those of other countries are taken up to
    the end of the run, or to a space before one of a country in the list."""
    known = "|".join(
        rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()
    )
    other = rf"(?!{COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!(?:{COUNTRIES})[0-9]{{2}}))?[A-Z0-9]){{11,30}}+"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})(?![A-Za-z0-9])"


# The patterns of the contract, written so that a failed match costs one pass: runs are taken
# whole (possessive) and begin at the start of a run or where the match before ended. Both
# forms find the same spans.
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": iban(),
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# A text without this cannot match the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
BASE = ("email", "ip", "card", "phone")
PART = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

# Score of a confirmed span, and of one with a context word before it.
SCORES = {
    "email": (0.9, 1.0), "ip": (0.6, 0.9), "card": (0.8, 1.0), "phone": (0.6, 0.9), "iban": (0.8, 1.0),
    "local_phone": (0.3, 0.7),
}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "tel", "call", "fax", "mobile"),
}
REACH = 40
MIN_SCORE = 0.5


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    doubled = F.transform(
        figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 test."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest, c):
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + letter) % 97)

    # both branches are computed by the conditional alone, so the cast never sees a letter
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"^0*{PART}(?:\.0*{PART}){{3}}$"))
    if kind == "card":
        return let(digits(value), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def found(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: ``kind, start, end`` in code points, ``value``."""
    pattern = PATTERNS[kind]
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")

    def place(matches):
        def build(between):
            def step(ends, i):
                before = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ends, i - 1))
                size = F.length(F.get(between, i)) + F.length(F.get(matches, i))
                return F.concat(ends, F.array((before + size).cast("long")))

            ends = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), F.array().cast("array<bigint>"), step)
            return F.zip_with(
                ends, matches, lambda end, value: F.struct(
                    F.lit(kind).alias("kind"), (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")
                )
            )

        spans = let(F.split(text, pattern, -1), build)
        return F.when(F.size(matches) == 0, none).otherwise(F.filter(spans, lambda s: confirmed(kind, s["value"])))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    needs = NEEDS.get(kind)
    return F.when(F.contains(text, F.lit(needs)), spans).otherwise(none) if needs else spans


def written(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def personal_data(
    docs: DataFrame,
    min_score: float = MIN_SCORE,
    scores: Mapping[str, tuple[float, float]] = SCORES,
    context: Mapping[str, Sequence[str]] = CONTEXT,
    reach: int = REACH,
) -> DataFrame:
    """Spans of personal data in every document, as ``found`` (kind, start, end, value, score).

    Six patterns propose spans, leftmost and non-overlapping per kind. Part ranges, digit
    counts, Luhn and mod-97 confirm them; one that fails is dropped without a second try. A span
    scores the first value of its kind, or the second if a context word stands in the ``reach``
    characters before it. The four base kinds always stay; account numbers and local telephone
    numbers are added if they reach ``min_score`` and overlap no base span. An account number
    ends where the length of its country says, whatever follows after a space.

    Null text is empty, and a document without spans has an empty list. Repeated rows and ids
    are searched one by one; no rows give no rows; other columns are left out. A row needs
    memory for its own text and spans only. JVM functions only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def scored(span):
        kind = span["kind"]
        start = F.greatest(span["start"] - reach, F.lit(0))
        before = F.lower(F.substring(text, (start + 1).cast("int"), (span["start"] - start).cast("int")))
        score = F.lit(None).cast("double")
        for name, (plain, near) in scores.items():
            hit = F.lit(False)
            for word in context.get(name, ()):
                hit = hit | F.contains(before, F.lit(word))
            score = F.when(kind == name, F.when(hit, F.lit(near)).otherwise(F.lit(plain))).otherwise(score)
        return F.struct(kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        span["value"].alias("value"), score.alias("score"))

    base = F.concat(*[found(text, kind) for kind in BASE])

    def whole(spans):
        added = F.concat(*[found(text, kind) for kind in PATTERNS if kind not in BASE])
        clear = F.filter(
            F.transform(added, scored),
            lambda s: (s["score"] >= min_score)
            & ~F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )
        return F.concat(F.transform(spans, scored), clear)

    rows = docs.select("doc_id", let(base, whole).alias("found"))
    of_base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return rows.select(
        "doc_id",
        *[F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(of_base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
        "found",
    )
