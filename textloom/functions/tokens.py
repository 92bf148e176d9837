"""Lossless word pieces and the arrays built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a piece is letters, digits, other signs (each with one leading
# blank if there is one) or a run of white space. Every character is in one piece.
PIECE = r" ?\p{L}+| ?\p{N}+| ?[^ \t\n\r\f\p{L}\p{N}]+|[ \t\n\r\f]+"


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def decode(tokens: Column) -> Column:
    return F.array_join(tokens, "")


def truncate_ids(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def pad_right(values: Column, width: Column, fill: int) -> Column:
    """Fill up to ``width``; longer arrays stay as they are."""
    missing = F.greatest(width - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(fill).cast("int"), missing))
