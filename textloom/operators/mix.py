"""Weighted repetition of chosen sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.sources.files import file_name, glob_to_regex
from textloom.sources.staging import stage


def usable_weights(entries: Sequence[Mapping[str, Any]]) -> list[tuple[str, int]]:
    """(pattern, weight) of each entry with a pattern and a weight of at least 1."""
    pairs = [(entry.get("path", ""), int(entry.get("weight", 1))) for entry in entries]
    return list(dict.fromkeys((path, weight) for path, weight in pairs if path and weight >= 1))


def match_sources(docs: DataFrame, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
    """One row per document and matching entry, with ``pattern`` and ``weight``.

    ``docs.path`` is relative to the input folder. The entries come from a config
    file and become constant patterns inside the projection, so nothing is joined.
    """
    hits = [
        F.when(
            F.col("path").rlike(glob_to_regex(pattern)),
            F.struct(F.lit(pattern).alias("pattern"), F.lit(weight).alias("weight")),
        )
        for pattern, weight in usable_weights(entries)
    ]
    none = F.array().cast("array<struct<pattern:string,weight:int>>")
    matches = F.array_compact(F.array(*hits)) if hits else none
    return (
        docs.withColumn("_match", F.explode(matches))
        .withColumns({"pattern": F.col("_match.pattern"), "weight": F.col("_match.weight")})
        .drop("_match")
    )


def copy_weight(docs: DataFrame, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Add ``weight``: the largest of a document's matching entries; others are dropped.

    Copies are named by number, so an entry of smaller weight adds no new name.
    """
    weights = [
        F.when(F.col("path").rlike(glob_to_regex(pattern)), weight)
        for pattern, weight in usable_weights(entries)
    ]
    # greatest() skips nulls and wants two arguments, so an empty list gives no match either.
    none = F.lit(None).cast("int")
    return docs.withColumn("weight", F.greatest(none, none, *weights)).where(F.col("weight").isNotNull())


# Shared stems within these bounds are sent to every executor; more of them are joined.
MAX_SENT_STEMS, MAX_SENT_STEM_BYTES = 500_000, 32 * 1024 * 1024


def with_stem(docs: DataFrame) -> DataFrame:
    """Add ``stem``: the name without its suffix, made unique where files share it.

    Names are settled before a text is read: a scan of the paths alone counts the stems, and those held by several
    files, one row each, are written down. Within the bounds they go to the texts, so that no text moves.
    """
    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumn("stem", F.regexp_replace(file_name(F.col("path")), r"(?<=.)\.[^.]+$", ""))

    counted = named(docs.select("path")).groupBy("stem").agg(F.count(F.lit(1)).alias("_files")).where("_files > 1")
    shared = stage(counted.select("stem", F.lit(True).alias("_shared")), "shared-stems")
    size = shared.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("stem")), F.lit(0)).alias("b")).first()
    if size["n"] <= MAX_SENT_STEMS and size["b"] <= MAX_SENT_STEM_BYTES:
        shared = F.broadcast(shared)
    mark = F.concat(F.col("stem"), F.lit("_"), F.md5("path"))
    return (
        named(docs).join(shared, "stem", "left")
        .withColumn("stem", F.when(F.col("_shared"), mark).otherwise(F.col("stem")))
        .drop("_shared")
    )


def oversample(docs: DataFrame, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
    """``weight`` copies of each matched document, named ``{stem}_{i:03d}.txt`` from 1."""
    return repeat_copies(with_stem(copy_weight(docs, entries)))


def repeat_copies(weighted: DataFrame) -> DataFrame:
    """Repeat rows with ``stem`` and ``weight``; ``source_file`` names the copy."""
    return (
        weighted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("weight"))))
        .withColumn("source_file", F.format_string("%s_%03d.txt", "stem", "copy"))
        .drop("stem", "weight")
    )


def mixture_report(docs: DataFrame, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Per entry: files, copies, characters after copying and their share; 0 files if unmatched."""
    found = (
        match_sources(docs.select("path", F.length("text").alias("_chars")), entries)
        .groupBy("pattern", "weight")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("_chars").alias("chars"))
    )
    listed = docs.sparkSession.createDataFrame(usable_weights(entries), "pattern string, weight int")
    report = listed.join(found, ["pattern", "weight"], "left").na.fill(0)
    report = report.withColumns(
        {"copies": F.col("files") * F.col("weight"), "staged_chars": F.col("chars") * F.col("weight")}
    )
    # One row per config entry, so the total is taken from the list itself.
    total = report.agg(F.sum("staged_chars").alias("t")).scalar()
    return report.select(
        "pattern", "weight", "files", "copies", "staged_chars",
        F.coalesce(F.col("staged_chars") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("share"),
    )


def unmatched_sources(docs: DataFrame, entries: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Entries that match no file."""
    return mixture_report(docs, entries).where("files = 0").select("pattern", "weight")
