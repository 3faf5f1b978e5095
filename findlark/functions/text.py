"""Text analysis. The token rule lives here and nowhere else."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
PIECE_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
FRAGMENT_CHARS = 100


def tokens(text: Column) -> Column:
    """Lower-cased words in order; the array index is the position. Null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def joined_tokens(text: Column) -> Column:
    """Lower-cased words in order, with characters between them that no word has: a text of ASCII
    letters as it is, which has words where ASCII letters, digits and underscores are, or else the
    words with spaces between them."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    plain = (F.octet_length(lower) == F.char_length(lower)) & F.is_valid_utf8(lower)
    return F.when(plain, lower).otherwise(F.array_join(tokens(text), " "))


def query_tokens(text: str) -> tuple[str, ...]:
    """The same rule for a query string (``\\w`` is letters, numbers and underscore)."""
    return tuple(re.findall(r"\w+", text.lower()))


def strip_stars(text: str | None) -> str:
    """Query text without leading and trailing ``*``."""
    return text.strip("*") if text else ""


def trim_stars(text: Column) -> Column:
    """Column form of :func:`strip_stars`."""
    return F.regexp_replace(text, r"^\*+|\*+$", "")


def fragments(text: Column, chars: int = FRAGMENT_CHARS) -> Column:
    """Text cut into trimmed runs of about ``chars`` characters."""
    # a run of up to that many that ends before whitespace, or one longer word
    pattern = rf"(?s)\S.{{0,{chars - 1}}}(?:\s|\z)|\S+"
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return F.transform(runs, lambda run: F.regexp_replace(run, r"^\s+|\s+$", ""))


def pieces(text: Column) -> Column:
    """Alternating words and separators; joining them gives the text back."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def bytes_to_text(data: Column) -> Column:
    """UTF-8 bytes as text, invalid bytes dropped."""
    return F.translate(F.make_valid_utf8(data.cast("string")), "�", "")


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters and their plain base letter, by canonical decomposition."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


# Letters that fold to more than one letter, or have no decomposition.
FOLD_WIDE = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l"}


def fold_ascii(text: Column) -> Column:
    """Latin letters without accents; characters outside the table stay as they are."""
    accented, plain = _fold_table()
    folded = F.translate(text, accented, plain)
    for letter, letters in FOLD_WIDE.items():
        folded = F.replace(folded, F.lit(letter), F.lit(letters))
    return folded


def html_text(html: Column) -> Column:
    """Readable text of an HTML page: scripts, styles, comments and tags become spaces."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))
