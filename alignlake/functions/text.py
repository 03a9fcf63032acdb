"""Column expressions for text: strip, words, token split. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace when a text is stripped or split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a regular-expression class. Property names match far faster than a list.
_SPACE = r"\s\p{Z}\x1C-\x1F\x85"

# Words, single punctuation marks and the four chat markers, which are never split.
TOKEN_REGEX = (
    r"<\|(?:system|user|assistant|end)\|>|[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s\p{Z}]"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for NULL and for text without a visible character."""
    return F.coalesce(strip(text), F.lit("")) == ""


def words(stripped: Column) -> Column:
    """Whitespace-separated words of an already stripped text; blank gives an empty array."""
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"[{_SPACE}]+")
    )


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words, without building an array."""
    return F.regexp_count(text, F.lit(f"[^{_SPACE}]+"))


def sentence_word_count(text: Column) -> Column:
    """Words summed over the pieces between full stops: runs free of whitespace and of '.'."""
    return F.regexp_count(text, F.lit(f"[^{_SPACE}.]+"))


def piece_count(text: Column) -> Column:
    """Number of pieces a split at '.' yields, empty trailing pieces included."""
    return F.length(text) - F.length(F.replace(text, F.lit("."), F.lit(""))) + 1


def tokens(text: Column) -> Column:
    """Token array of a text: chat markers, words, punctuation."""
    return F.regexp_extract_all(text, F.lit(TOKEN_REGEX), F.lit(0))


def preview(text: Column, width: int = 200) -> Column:
    """The first ``width`` characters, followed by dots when something was cut."""
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in candidates], F.lit(""))
