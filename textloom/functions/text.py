"""Column helpers whose results equal Python's string methods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, and the same set as
# a regex class that Java and RE2 both read.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return text.isNull() | (strip(text) == "")


def is_upper(text: Column) -> Column:
    """str.isupper(): some cased character, none of them lower or title case."""
    return text.rlike(r"\p{IsUppercase}") & ~text.rlike(r"[\p{IsLowercase}\p{Lt}]")


def has_lower(text: Column) -> Column:
    return text.rlike(r"\p{IsLowercase}")


def word_count(stripped: Column) -> Column:
    """Words of an already stripped, non-empty text."""
    return F.size(F.split(stripped, WS + "+"))


def normalize_newlines(text: Column) -> Column:
    r"""``\r\n`` and lone ``\r`` become ``\n``."""
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.when(text.contains("\r"), plain).otherwise(text)


def collapse_spaces(text: Column) -> Column:
    """Runs of U+0020 become one; tabs stay. Texts without a run skip the regex."""
    return F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def collapse_blank_lines(text: Column) -> Column:
    """At most one empty line in a row; a line holding a space is not empty."""
    return F.when(text.contains("\n\n\n"), F.regexp_replace(text, "\n{3,}", "\n\n")).otherwise(text)


def normalize_whitespace(text: Column) -> Column:
    tidy = text
    for step in (normalize_newlines, collapse_spaces, collapse_blank_lines, strip):
        tidy = let(tidy, step)
    return tidy


def sanitize_encoding(text: Column, errors: str = "replace") -> Column:
    """Broken UTF-8 becomes U+FFFD, or nothing with ``ignore``; a no-op on valid text."""
    if errors != "ignore":
        return F.make_valid_utf8(text)
    # U+FFFD that the text itself holds is written as a sign and a letter meanwhile, and so is that sign.
    bad, sign, of_sign, of_bad = F.lit("\ufffd"), F.lit("\ufdd0"), F.lit("\ufdd0s"), F.lit("\ufdd0b")
    safe = F.make_valid_utf8(F.replace(F.replace(text, sign, of_sign), bad, of_bad))
    dropped = F.replace(F.replace(F.replace(safe, bad, F.lit("")), of_bad, bad), of_sign, sign)
    return F.when(F.is_valid_utf8(text), text).otherwise(dropped)


def truncate_text(text: Column, max_length: int) -> Column:
    return F.substring(text, 1, max_length)
