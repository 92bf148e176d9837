"""A bitmap of hashes, of a fixed size, that tells tasks which rows cannot match."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import U64

#: 2 MB whatever is put in.
SIEVE_BITS = 24


def sieve_of(grams: DataFrame, bits: int = SIEVE_BITS) -> np.ndarray:
    """A bit for each value of a gram hash's top ``bits`` bits that occurs: at most 2**(bits-6) rows of 64 bits."""
    top = F.shiftrightunsigned("gram", 64 - bits)
    filled = grams.select(
        F.shiftright(top, 6).alias("word"), top.bitwiseAND(F.lit(63)).cast("int").alias("place")
    ).select("word", F.expr("shiftleft(1L, place)").alias("bit"))
    found = filled.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(U64)


def in_sieve(sieve: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    top = hashes >> U64(64 - bits)
    return (sieve[(top >> U64(6)).astype(np.int64)] >> (top & U64(63))) & U64(1) != 0
