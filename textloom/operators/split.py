"""Exact, repeatable train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_DIGITS = 3  # 4,096 prefixes: what one counting pass returns at most
SMALL_BUCKET = 4096  # hashes fetched whole


def check_ratios(ratios: Sequence[float]) -> None:
    if len(ratios) != 3 or abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError(f"Split ratios must be three numbers that sum to 1.0, got {list(ratios)}")


def split_sizes(total: int, ratios: Sequence[float]) -> tuple[int, int]:
    """Rows in train and validation; test takes the rest."""
    return int(total * ratios[0]), int(total * ratios[1])


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """md5 of the seed and the row's unique keys: a random order, without a shuffle.

    Keys are joined by colons; their own colons are escaped and a null has a sign of its own, so different keys differ.
    """
    def written(key: str) -> Column:
        text = F.col(key).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))
        return F.coalesce(escaped, F.lit("\\0"))

    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[written(k) for k in keys]))


def split_exact(
    df: DataFrame,
    keys: Sequence[str] = ("chunk_id",),
    ratios: Sequence[float] = (0.8, 0.1, 0.1),
    seed: int = 42,
    group_col: str | None = None,
) -> DataFrame:
    """Add ``split``: rows in hash order, cut at the exact sizes.

    With ``group_col`` groups are ordered instead, and a group goes whole to the split of
    its first row, so no group is in two splits and sizes are as near as groups allow. Rows
    with a null group are one group.

    No row is moved or sorted. Counting hashes by prefix finds the two hashes at
    which the order is cut; each row then compares its own hash with them. The
    passes read only the key columns, so hand in a staged table.
    """
    check_ratios(ratios)
    order = row_hash([group_col] if group_col else keys, seed)
    hashes = df.select(order.alias("h"))
    counts = _prefix_counts(hashes, FIRST_DIGITS)
    total = sum(counts.values())
    if total == 0:
        raise ValueError("Cannot split empty dataset")
    train, validation = split_sizes(total, ratios)
    first = _cut(hashes, counts, train, bool(group_col))
    second = _cut(hashes, counts, train + validation, bool(group_col))
    h = F.col("_hash")
    name = F.when(h < first, "train").when(h < second, "validation").otherwise("test")
    return df.withColumn("_hash", order).withColumn("split", name).drop("_hash")


def _prefix_counts(hashes: DataFrame, digits: int) -> dict[str, int]:
    rows = hashes.groupBy(F.substring("h", 1, digits).alias("p")).count().collect()
    return {row["p"]: row["count"] for row in rows}


def _cut(hashes: DataFrame, counts: dict[str, int], rank: int, whole: bool) -> str:
    """The string that exactly ``rank`` hashes sort before; with ``whole``, equal hashes stay together before it."""
    prefix = ""
    while True:
        for next_prefix in sorted(counts):
            if rank < counts[next_prefix]:
                break
            rank -= counts[next_prefix]
        else:
            return "g"  # all rows: past the last hex digit
        if rank == 0:
            return next_prefix
        if len(next_prefix) == 32:
            if whole:
                return next_prefix + "0"  # the next string after the group's hash
            raise ValueError("the keys must be unique: some rows have the same hash")
        prefix, held = next_prefix, counts[next_prefix]
        digits = 32 if held <= SMALL_BUCKET else len(prefix) + FIRST_DIGITS
        counts = _prefix_counts(hashes.where(F.col("h").startswith(prefix)), min(digits, 32))


def split_ordered(
    df: DataFrame, order: str = "chunk_id", ratios: Sequence[float] = (0.8, 0.1, 0.1)
) -> DataFrame:
    """The same sizes without shuffling; ``order`` runs 0, 1, 2, ..."""
    check_ratios(ratios)
    total = df.count()
    if total == 0:
        raise ValueError("Cannot split empty dataset")
    train, validation = split_sizes(total, ratios)
    return df.withColumn(
        "split",
        F.when(F.col(order) < train, "train")
        .when(F.col(order) < train + validation, "validation")
        .otherwise("test"),
    )
