"""Tables of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_documents(spark: SparkSession, path: str, *columns: str, partitions: int | None = None) -> DataFrame:
    """The wanted columns of a parquet table.

    ``partitions`` deals the rows anew, for a small file whose single row group would keep
    all cores but one idle. That shuffles the texts, so a table of many files goes without.
    """
    rows = spark.read.parquet(path).select(*columns)
    return rows.repartition(partitions) if partitions else rows
