"""The row-wise steps and the corpus counts as streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.chunk import chunk_text
from textloom.operators.clean import CleanOptions, clean_batch
from textloom.operators.stats import source_counts
from textloom.sources.staging import drop_folder, hadoop_path, materialize_stage, read_manifest


def clean_and_chunk(
    documents: DataFrame, options: CleanOptions = CleanOptions(), size: int = 512, overlap: int = 50,
    by: str = "tokens",
) -> DataFrame:
    """The batch operators, unchanged, on a stream of documents; nothing is kept between batches."""
    return chunk_text(clean_batch(documents, options).drop("metadata"), size, overlap, by)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a parquet table; the checkpoint makes a restart exact."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


VERSIONS_KEPT = 2


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, root = hadoop_path(spark, path)
    names = [e.getPath().getName() for e in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.removeprefix("version-")) for n in names if n.startswith("version-"))


def add_source_counts(documents: DataFrame, batch: int, path: str) -> bool:
    """Add one batch to the counts kept in ``path``; false where that batch, or a later one, is in them already.

    The counts after a batch are one whole table, a row per source, published in one step under the batch's number. So a
    batch that is replayed, or was cut off half-way, counts once, and a reader reads one version however many batches
    there were. The last ``VERSIONS_KEPT`` versions stay, for readers that have begun.
    """
    spark = documents.sparkSession
    known = _versions(spark, path)
    if known and known[-1] >= batch and read_manifest(spark, f"{path}/version-{known[-1]}") is not None:
        return False
    counts = source_counts(documents)
    if earlier := [v for v in known if v < batch]:
        before = spark.read.parquet(f"{path}/version-{earlier[-1]}").select(*counts.columns)
        counts = counts.unionByName(before).groupBy("source_file").agg(
            *[F.sum(c).alias(c) for c in counts.columns if c != "source_file"]
        )
    materialize_stage(spark, f"{path}/version-{batch}", lambda: counts)
    for old in _versions(spark, path)[:-VERSIONS_KEPT]:
        drop_folder(spark, f"{path}/version-{old}")
    return True


def write_source_counts(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running texts and characters per source file; ``read_source_counts`` reads their current state."""
    return (
        documents.writeStream.foreachBatch(lambda rows, batch: add_source_counts(rows, batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_source_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts after the last whole batch."""
    for version in reversed(_versions(spark, path)):
        if read_manifest(spark, f"{path}/version-{version}") is not None:
            return spark.read.parquet(f"{path}/version-{version}")
    raise FileNotFoundError(f"no counts in {path}")
