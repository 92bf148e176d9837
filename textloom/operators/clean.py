"""Cleaning of documents, with the statistics of every step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.boilerplate import remove_footers, remove_headers, strip_pg_boilerplate
from textloom.functions.rows import where_computed
from textloom.functions.text import normalize_whitespace, sanitize_encoding, truncate_text


@dataclass(frozen=True)
class CleanOptions:
    remove_headers: bool = True
    remove_footers: bool = True
    normalize_whitespace: bool = True
    min_text_length: int = 1
    max_text_length: int | None = None
    filter_by_length: bool = False
    handle_encoding_errors: str = "replace"


def clean(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Clean ``text`` in every row; adds ``cleaning_stats``. Dropped texts become null.

    Each step is a column of its own that the next one reads, so the optimizer
    keeps them as separate projections and evaluates each once.
    """
    same = F.col
    steps = df.withColumn("_given", F.when(F.col("text") != "", F.col("text")))
    steps = steps.withColumn("_book", strip_pg_boilerplate(F.col("_given")))
    steps = steps.withColumn(
        "_head", remove_headers(F.col("_book")) if options.remove_headers else same("_book")
    )
    steps = steps.withColumn(
        "_foot", remove_footers(F.col("_head")) if options.remove_footers else same("_head")
    )
    tidy = normalize_whitespace(F.col("_foot")) if options.normalize_whitespace else same("_foot")
    if options.handle_encoding_errors != "strict":
        tidy = sanitize_encoding(tidy, options.handle_encoding_errors)
    steps = steps.withColumns(
        {
            "_tidy": tidy,
            "_lengths": F.struct(
                *[F.length(f"_{step}").alias(step) for step in ("given", "book", "head", "foot")]
            ),
        }
    ).withColumn("_n", F.length("_tidy"))
    final = F.col("_tidy")
    if options.max_text_length is not None:
        final = truncate_text(final, options.max_text_length)
    if options.filter_by_length:
        final = F.when(F.col("_n") >= options.min_text_length, final)
    return (
        steps.withColumns({"text": final, "cleaning_stats": _stats(options)})
        .drop("_given", "_book", "_head", "_foot", "_tidy", "_lengths", "_n")
    )


def _stats(options: CleanOptions) -> Column:
    length = F.col("_lengths")
    empty = length["given"].isNull()
    short = F.lit(False)
    if options.filter_by_length:
        short = F.col("_n") < options.min_text_length
    # The header and footer marks compare with the original length, so an earlier cut sets them too.
    applied = [F.when(length["book"] < length["given"], "pg_boilerplate_removal")]
    if options.remove_headers:
        applied.append(F.when(length["head"] < length["given"], "header_removal"))
    if options.remove_footers:
        applied.append(F.when(length["foot"] < length["given"], "footer_removal"))
    if options.normalize_whitespace:
        applied.append(F.lit("whitespace_normalization"))
    final_length = F.col("_n")
    if options.max_text_length is not None:
        cut = ~short & (F.col("_n") > options.max_text_length)
        applied.append(F.when(cut, "truncation"))
        final_length = F.least(final_length, F.lit(options.max_text_length))
    kept = ~empty & ~short
    reason = F.concat(
        F.lit("too_short ("), F.col("_n").cast("string"), F.lit(f" < {options.min_text_length})")
    )
    return F.struct(
        F.coalesce(length["given"], F.lit(0)).alias("original_length"),
        (empty | short).alias("filtered"),
        F.when(empty, "empty").when(short, reason).alias("reason"),
        F.when(~empty, F.array_compact(F.array(*applied))).alias("operations_applied"),
        F.when(kept, final_length).alias("final_length"),
        F.when(kept, length["given"] - final_length).alias("characters_removed"),
    )


def clean_batch(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Non-empty documents that pass the filters, with their statistics in ``metadata``."""
    cleaned = where_computed(clean(df, options), F.col("text").isNotNull())
    if "metadata" in df.columns:
        stats = F.col("metadata").withField("cleaning_stats", F.col("cleaning_stats"))
    else:
        stats = F.struct(F.col("cleaning_stats"))
    return cleaned.withColumn("metadata", stats).drop("cleaning_stats")


def filter_by_length(df: DataFrame, min_length: int) -> DataFrame:
    """Texts of at least ``min_length`` characters."""
    return df.where(F.length("text") >= min_length)


def clean_batch_summary(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Passed, filtered and total counts; empty texts are not counted."""
    stat = F.col("cleaning_stats")
    given = stat["original_length"] > 0
    return (
        clean(df, options)
        .select(stat["filtered"].alias("filtered"), given.alias("given"))
        .agg(
            F.count_if(F.col("given")).alias("total"),
            F.count_if(F.col("given") & ~F.col("filtered")).alias("passed"),
            F.count_if(F.col("given") & F.col("filtered")).alias("filtered"),
        )
    )
