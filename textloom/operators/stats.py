"""Statistics of documents, chunks and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.tokens import tokenize
from textloom.sources.datasets import SPLITS


def _split_aggregates() -> list:
    positive = F.when(F.col("token_count") > 0, F.col("token_count"))
    return [
        F.count(F.lit(1)).alias("num_examples"),
        F.coalesce(F.sum(positive), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.avg("text_length"), F.lit(0.0)).alias("avg_text_length"),
        F.coalesce(F.avg(positive), F.lit(0.0)).alias("avg_token_count"),
    ]


def split_statistics(df: DataFrame) -> DataFrame:
    """One row per split, zeros for an empty one."""
    stats = df.groupBy("split").agg(*_split_aggregates())
    names = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return names.join(stats, "split", "left").na.fill(0)


def split_source_histogram(df: DataFrame) -> DataFrame:
    """Rows per source file in each split, as rows: a map per split would grow with the sources."""
    return df.groupBy("split", "source_file").agg(F.count(F.lit(1)).alias("num_examples"))


def split_totals(df: DataFrame) -> DataFrame:
    """Examples and tokens per split and in ``total``."""
    positive = F.when(F.col("token_count") > 0, F.col("token_count"))
    return (
        df.rollup("split")
        .agg(
            F.count(F.lit(1)).alias("num_examples"),
            F.coalesce(F.sum(positive), F.lit(0)).alias("total_tokens"),
            F.grouping("split").alias("_all"),
        )
        .select(F.when(F.col("_all") == 1, "total").otherwise(F.col("split")).alias("split"),
                "num_examples", "total_tokens")
    )


def corpus_statistics(df: DataFrame) -> DataFrame:
    """Texts, characters and mean length per source file, and over all (``source_file`` null)."""
    return source_counts(df).rollup("source_file").agg(
        F.sum("num_texts").alias("num_texts"),
        F.sum("total_chars").alias("total_chars"),
        (F.sum("total_chars") / F.sum("num_texts")).alias("avg_chars"),
    )


def source_counts(df: DataFrame) -> DataFrame:
    """Texts and characters per source file; the rollup above expands these rows, not the texts."""
    return (
        df.select("source_file", F.length("text").alias("_chars"))
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("num_texts"), F.sum("_chars").alias("total_chars"))
    )


def dataset_token_statistics(df: DataFrame) -> DataFrame:
    """Chunks, columns, total and mean tokens."""
    return df.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.lit(",".join(df.columns)).alias("features"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_tokens"),
    )


def training_step_plan(df: DataFrame, batch_size: int, accumulation: int, epochs: int) -> DataFrame:
    """Examples, effective batch and optimizer steps per split."""
    effective = batch_size * accumulation
    return (
        df.groupBy("split")
        .agg(F.count(F.lit(1)).alias("num_examples"))
        .select(
            "split",
            "num_examples",
            F.lit(effective).cast("bigint").alias("effective_batch"),
            (F.floor(F.col("num_examples") / effective) * epochs).cast("bigint").alias("total_steps"),
        )
    )


def perplexity_by_split(df: DataFrame) -> DataFrame:
    """Perplexity of validation and test under a unigram add-one model counted on train.

    Tokens are counted once for all splits, one row per token, so a frequent token
    is summed before the shuffle and no join is needed. The model's vocabulary is
    the train tokens and one entry for all others.
    """
    def rows(name: str):
        return F.count_if(F.col("split") == name)

    tokens = (
        df.select("split", F.explode(tokenize(F.col("text"))).alias("token"))
        .groupBy("token")
        .agg(*[rows(name).alias(name) for name in SPLITS])
    )
    log_count = F.log(F.col("train") + 1.0)
    sums = tokens.agg(
        F.sum("train").alias("n"),
        F.count_if(F.col("train") > 0).alias("v"),
        *[F.sum(name).alias(f"{name}_tokens") for name in SPLITS[1:]],
        *[F.sum(F.col(name) * log_count).alias(f"{name}_logs") for name in SPLITS[1:]],
    )
    result = sums.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("split"),
                        F.col(f"{name}_tokens").alias("num_tokens"),
                        (
                            F.log(F.col("n") + F.col("v") + 1.0)
                            - F.col(f"{name}_logs") / F.nullif(F.col(f"{name}_tokens"), F.lit(0))
                        ).alias("loss"),
                    )
                    for name in SPLITS[1:]
                ]
            )
        ).alias("r")
    )
    return result.select("r.split", "r.num_tokens", "r.loss", F.exp("r.loss").alias("perplexity"))
