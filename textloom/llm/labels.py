"""Labelled rows for the classifiers: folds by id, and a bounded, balanced sample to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, label`` of at most ``per_class`` learning rows a class, and all learning rows' counts by class.

    Rows are taken in the order of a hash of the id, so the choice has nothing to do with
    place or size. Only ids are ranked; at most ``2 * per_class`` of them, so they can be sent to the scan.
    """
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    mixed = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).orderBy(mixed, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id")
    # An id may stand more than once, in either table: one row each is learned from, the least by its text's hash.
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select(
        "doc_id", "text", "label"
    ), counts
