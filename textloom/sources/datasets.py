"""Chunk tables on disk: write, read back by split, describe, stream."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.sources.staging import hadoop_path, path_exists, read_manifest, write_manifest

logger = logging.getLogger(__name__)

SPLITS = ("train", "validation", "test")
FORMATS = ("jsonl", "parquet")


def _check_format(fmt: str) -> str:
    if fmt.lower() not in FORMATS:
        raise ValueError(f"Invalid output format: {fmt}. Must be one of: {', '.join(FORMATS)}")
    return fmt.lower()


def write_dataset(
    df: DataFrame,
    output_dir: str | None,
    fmt: str = "jsonl",
    filename: str | None = None,
    split_name: str | None = None,
) -> str:
    """Write to ``output_dir/name.fmt`` and return that path."""
    fmt = _check_format(fmt)
    if not output_dir:
        raise ValueError("output_dir must be set to save a dataset")
    path = f"{output_dir.rstrip('/')}/{filename or split_name or 'dataset'}.{fmt}"
    counted, rows = _counted(df, {"rows": F.count(F.lit(1))})
    _write(counted.write.mode("overwrite"), fmt, path)
    write_manifest(df.sparkSession, path, rows=rows()["rows"])
    return path


def _write(writer: DataFrameWriter, fmt: str, path: str) -> None:
    if fmt == "jsonl":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)


def _counted(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows, and what their writing will have counted on the way."""
    seen = Observation()
    counted = df.observe(seen, *[value.alias(name) for name, value in counts.items()])
    return counted, lambda: {name: seen.get.get(name) or 0 for name in counts}


def write_splits(
    df: DataFrame, output_dir: str, fmt: str = "jsonl", partitioned: bool = False
) -> dict[str, str]:
    """One output per split, all written in a single pass over ``df``.

    The rows are counted on the way, for each split's manifest. They are written partitioned by ``split`` next to the
    outputs, and each partition's folder is then given its name. With ``partitioned`` they stay one
    table below ``dataset.fmt``, which costs no renaming on an object store.
    """
    fmt = _check_format(fmt)
    spark, root = df.sparkSession, output_dir.rstrip("/")
    written = f"{root}/dataset.{fmt}" if partitioned else f"{root}/_writing-{uuid.uuid4().hex}"
    counted, rows = _counted(df, {name: F.count_if(F.col("split") == name) for name in SPLITS})
    _write(counted.write.mode("overwrite").partitionBy("split"), fmt, written)
    number = rows()
    if partitioned:
        paths = {name: f"{written}/split={name}" for name in SPLITS}
        for name, path in paths.items():
            if path_exists(spark, path):
                write_manifest(spark, path, rows=number[name])
        return paths
    paths = {}
    for name in SPLITS:
        paths[name] = f"{root}/{name}.{fmt}"
        fs, target = hadoop_path(spark, paths[name])
        _, source = hadoop_path(spark, f"{written}/split={name}")
        if not fs.exists(source):
            write_dataset(spark.createDataFrame([], df.drop("split").schema), root, fmt, name)
            continue
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"could not rename {source.toString()} to {paths[name]}")
        fs.create(hadoop_path(spark, f"{paths[name]}/_SUCCESS")[1], True).close()
        write_manifest(spark, paths[name], rows=number[name])
    fs.delete(hadoop_path(spark, written)[1], True)
    return paths


def find_split(spark: SparkSession, data_dir: str, name: str) -> tuple[str, str] | None:
    """(path, format) of the first existing output of a split; one of its own before a partition."""
    root = data_dir.rstrip("/")
    own = [(f"{root}/{name}.{fmt}", fmt) for fmt in FORMATS]
    parts = [(f"{root}/dataset.{fmt}/split={name}", fmt) for fmt in FORMATS]
    return next(((path, fmt) for path, fmt in own + parts if path_exists(spark, path)), None)


def _found_or_raise(spark: SparkSession, data_dir: str, name: str) -> tuple[str, str]:
    found = find_split(spark, data_dir, name)
    if found is None:
        wanted = " or ".join(f"{name}.{fmt}" for fmt in FORMATS)
        raise FileNotFoundError(f"Split file not found for '{name}' in {data_dir}. Expected: {wanted}")
    return found


def read_split(
    spark: SparkSession, data_dir: str, name: str, schema: StructType | str, fmt: str | None = None
) -> DataFrame:
    """A split's rows. An explicit format wins over the suffix; blank JSON lines are skipped."""
    path, found = _found_or_raise(spark, data_dir, name)
    reader = spark.read.schema(schema)
    return reader.json(path) if _check_format(fmt or found) == "jsonl" else reader.parquet(path)


def read_splits(
    spark: SparkSession,
    data_dir: str,
    schema: StructType | str,
    splits: Sequence[str] | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """All wanted splits in one table with a ``split`` column; missing ones are warned about."""
    if not path_exists(spark, data_dir):
        raise FileNotFoundError(f"Data directory not found: {data_dir}")
    table = None
    for name in SPLITS if splits is None else splits:
        try:
            rows = read_split(spark, data_dir, name, schema, fmt).withColumn("split", F.lit(name))
        except FileNotFoundError as error:
            logger.warning("Could not load %s: %s", name, error)
            continue
        table = rows if table is None else table.unionByName(rows)
    if table is not None:
        return table
    if splits is None:
        raise FileNotFoundError(f"No dataset splits found in {data_dir}")
    return spark.createDataFrame([], spark.read.schema(schema).json([]).schema).withColumn("split", F.lit(""))


def stream_split(
    spark: SparkSession, data_dir: str, name: str, schema: StructType | str, fmt: str | None = None
) -> DataFrame:
    """The same rows as a stream over the split's files."""
    path, found = _found_or_raise(spark, data_dir, name)
    reader = spark.readStream.schema(schema)
    return reader.json(path) if _check_format(fmt or found) == "jsonl" else reader.parquet(path)


def count_rows(spark: SparkSession, path: str, fmt: str) -> int:
    """Rows of a written table: as its manifest says, if its files are those that the manifest lists.

    Otherwise they are counted; of parquet that reads the files' footers only.
    """
    known = read_manifest(spark, path)
    if known is not None and "rows" in known:
        return known["rows"]
    return (spark.read.schema("_row string").json(path) if fmt == "jsonl" else spark.read.parquet(path)).count()


def dataset_info(spark: SparkSession, data_dir: str, schema: StructType | str | None = None) -> DataFrame:
    """Available splits: path, format, size in bytes, rows. No data is read where manifests tell the rows."""
    rows = []
    for name in SPLITS:
        found = find_split(spark, data_dir, name)
        if found is not None:
            path, fmt = found
            fs, p = hadoop_path(spark, path)
            rows.append((name, path, fmt, fs.getContentSummary(p).getLength(), count_rows(spark, path, fmt)))
    return spark.createDataFrame(rows, "split string, path string, format string, size bigint, num_rows bigint")
