"""Boilerplate, header and footer removal as column expressions.

Headers and footers: each of the 15 lines in question gets a one-letter class,
the letters are joined to a short word, and a regular expression on that word
finds how far the removal reaches. Only the first (or last) 15 line breaks of a
text are looked for; the rest of it is never split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import WS, has_lower, is_upper, let, strip, word_count

LINES_CHECKED = 15

# What a header line starts with, ignoring case.
HEADER_STARTS = (
    r"https?://",
    r"www\.",
    r"Copyright",
    r"\(C\)",
    r"\p{Nd}{1,2}$",
    r"Page \p{Nd}+",
    r"Project Gutenberg",
    r"Etext",
    r"Release Date",
    r"\[.*?\]$",
    r"Title:",
    r"Author:",
    r"Language:",
    r"Character set encoding:",
    r"[*=_-]{3,}",
)

# What a footer line starts with, ignoring case.
FOOTER_STARTS = (
    r"\p{Nd}+$",
    r"Page \p{Nd}+",
    rf"-{WS}*\p{{Nd}}+{WS}*-",
    r"Copyright",
    r"\(C\)",
    r"End of.*Project Gutenberg",
    r"End of the Project Gutenberg",
    r"\*\*\* END OF.*\*\*\*",
    r"\[.*?\]$",
    r"[*=_-]{3,}",
)

# The markers around an e-book's own text.
START_MARK, END_MARK, BOOK_MARK = "*** START OF", "*** END OF", "PROJECT GUTENBERG"

# How far a removal reaches, as patterns over line classes
# (E empty, H header, F footer, C content, M may be either).
HEADER_REACH = "^[EM]*(?:H[EM]*(?:H[EH]*)?)?"
FOOTER_REACH = "^[EM]*(?:F[EF]*)?"


def starts_regex(starts: tuple[str, ...], flags: str = "(?iud)") -> str:
    return flags + "^(?:" + "|".join(starts) + ")"


def strip_pg_boilerplate(text: Column) -> Column:
    """Keep the lines between the first START and the last END marker line, if in that order."""

    def marked(line: Column, mark: str) -> Column:
        return line.contains(mark) & line.contains(BOOK_MARK)

    def cut(lines: Column) -> Column:
        upper = F.transform(lines, F.upper)
        start = F.array_min(_places(upper, lambda line: marked(line, START_MARK)))
        end = F.array_max(_places(upper, lambda line: marked(line, END_MARK)))
        return let(
            F.struct(start.alias("start"), end.alias("end")),
            lambda m: F.when(
                m["start"] + 1 < m["end"],
                F.array_join(F.slice(lines, m["start"] + 2, m["end"] - m["start"] - 1), "\n"),
            ),
        )

    # Asterisks and blanks have no case, so most texts are ruled out by one search.
    kept = F.when(text.contains("*** "), let(F.split(text, "\n"), cut))
    return F.coalesce(kept, text)


def _places(lines: Column, test) -> Column:
    """0-based positions of the lines that pass."""
    found = F.transform(lines, lambda line, i: F.when(test(line), i))
    return F.filter(found, lambda i: i.isNotNull())


def _reach(kinds: Column, pattern: str, mark: str, free: int) -> Column:
    """Lines to cut: up to the last ``mark`` in reach, or the last empty one among the first ``free``."""
    return let(
        F.regexp_extract(kinds, pattern, 0),
        lambda reach: F.greatest(
            F.length(F.regexp_extract(reach, f"^.*{mark}", 0)),
            F.length(F.regexp_extract(F.substring(reach, 1, free), "^.*E", 0)),
        ),
    )


def _header_kind(line: Column) -> Column:
    lower = F.lower(line)
    header = (
        line.rlike(starts_regex(HEADER_STARTS))
        | ((F.length(line) < 80) & is_upper(line) & (word_count(line) < 10))
        | (line.contains("@") & (lower.contains("http") | lower.contains("www")))
    )
    return (
        F.when(line == "", "E")
        .when(header, "H")
        .when((F.length(line) > 20) | has_lower(line), "C")
        .otherwise("M")
    )


def _footer_kind(line: Column, from_end: Column) -> Column:
    short_caps = is_upper(line) & (word_count(line) <= 3)
    footer = line.rlike(starts_regex(FOOTER_STARTS)) | (
        (F.length(line) < 20) & (from_end < 3) & short_caps
    )
    return (
        F.when(line == "", "E")
        .when(footer, "F")
        .when((F.length(line) > 30) | has_lower(line), "C")
        .otherwise("M")
    )


def remove_headers(text: Column) -> Column:
    """Cut header lines among the first 15; texts of 15 lines or fewer stay."""

    def cut(parts: Column) -> Column:
        head = F.transform(F.slice(parts, 1, LINES_CHECKED), strip)
        kinds = F.array_join(F.transform(head, _header_kind), "")
        return let(
            _reach(kinds, HEADER_REACH, "H", 5),
            lambda n: F.when(n > 0, F.array_join(F.slice(parts, n + 1, LINES_CHECKED + 1), "\n")),
        )

    parts = F.split(text, "\n", LINES_CHECKED + 1)
    kept = let(parts, lambda p: F.when(F.size(p) > LINES_CHECKED, cut(p)))
    return F.coalesce(kept, text)


def remove_footers(text: Column) -> Column:
    """Cut footer lines among the last 15, looking upward; texts of 15 lines or fewer stay."""

    def last_lines(count: Column) -> Column:
        return F.call_function("substring_index", text, F.lit("\n"), -count)

    def cut(tail: Column) -> Column:
        lines = F.reverse(F.transform(F.split(tail, "\n"), strip))
        kinds = F.array_join(F.transform(lines, _footer_kind), "")
        return let(
            _reach(kinds, FOOTER_REACH, "F", 3),
            lambda n: F.when(
                n > 0,
                F.substring(text, F.lit(1), F.length(text) - F.length(last_lines(n)) - 1),
            ),
        )

    tail = last_lines(F.lit(LINES_CHECKED))
    kept = let(tail, lambda t: F.when(F.length(t) < F.length(text), cut(t)))
    return F.coalesce(kept, text)
