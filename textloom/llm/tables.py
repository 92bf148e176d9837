"""Shared ground of the operators: their inputs, staged tables, Arrow maps over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.staging import hadoop_path, new_folder, shuffles_freed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id bigint, text string`` only, so that no other column can clash; null text is empty."""
    return docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


class Workspace:
    """The tables that one run of an operator writes to the cluster's shared folder.

    A written table outlives lost executors and is read by column. Tables go as soon as
    no later step reads them; ``finish`` writes the result and leaves nothing else.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = new_folder(spark, name)
        self.names: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with shuffles_freed(self.spark):
            df.write.parquet(path)
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = hadoop_path(self.spark, f"{self.folder}/{name}")
            fs.delete(path, True)
            self.names.remove(name)

    def finish(self, df: DataFrame) -> DataFrame:
        result = self.stage(df, "result")
        self.drop(*[name for name in self.names if name != "result"])
        return result


def map_texts(df: DataFrame, rows: Callable[[list, list], pa.RecordBatch], schema: str) -> DataFrame:
    """``rows(doc ids, texts)`` applied to slices of bounded size of each Arrow batch of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                yield rows(part.column("doc_id").to_pylist(), part.column("text").to_pylist())

    return df.select("doc_id", "text").mapInArrow(run, schema)
