"""The inputs of the registered queries: whole tables, or frames derived from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.chunk import assign_chunk_ids, staged_chunks
from textloom.sources.staging import Scratch, stage
from textloom.sources.tables import read_documents

START_LINE = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END_LINE = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"

WEIGHTS = [
    {"path": "src1/*.txt", "weight": 20},
    {"path": "src1*/*.txt", "weight": 3},
    {"path": "src[2-4]/src?_00*.txt", "weight": 2},
    {"path": "src5/*.txt", "weight": 0},
    {"path": "", "weight": 3},
    {"path": "absent/*.txt", "weight": 5},
    {"path": "src[!0-8]/*", "weight": 1},
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.conf.get("spark.textloom.partitions", None)
    columns = ("doc_id", "source", "text")
    return read_documents(spark, f"{sf_dir}/documents.parquet", *columns, partitions=int(given) if given else None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source_file, text."""
    name = F.format_string("%s_%06d.txt", "source", "doc_id")
    return _texts(spark, sf_dir).select("doc_id", name.alias("source_file"), "text")


def placed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a ``path`` inside a folder per source."""
    name = F.format_string("%s/%s_%06d.txt", "source", "source", "doc_id")
    return _texts(spark, sf_dir).select("doc_id", name.alias("path"), "text")


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents broken into lines, with headers, footers, markers, odd blanks or nothing in them."""
    kind = F.col("doc_id") % 6
    body = F.regexp_replace("text", "([.!?]) ", "$1\n")

    def lines(*parts):
        return F.concat_ws("\n", *[p if not isinstance(p, str) else F.lit(p) for p in parts])

    wide = F.replace(F.replace(body, F.lit(" "), F.lit("   ")), F.lit("\n"), F.lit("\r\n\r\n\r\n"))
    text = (
        F.when(kind == 0, lines("https://example.org/item", "Copyright 2024", "", "[Title]", body))
        .when(kind == 1, lines(body, "", "Page 3 of 9", "Copyright 2024", "17"))
        .when(kind == 2, lines("The eBook of X", START_LINE, body, END_LINE, "The last line."))
        .when(kind == 3, wide)
        .when(kind == 4, F.when(F.col("doc_id") % 12 == 4, "").otherwise("   "))
        .otherwise(F.col("text"))
    )
    return documents(spark, sf_dir).withColumn("text", text)


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of five kinds, in the columns of a binary file scan."""
    kind = F.col("doc_id") % 5
    suffix = F.element_at(F.array(*[F.lit(s) for s in (".txt", ".RTF", ".txt", ".pdf", ".TXT")]), (kind + 1).cast("int"))
    rtf = F.col("text")
    for old, new in (("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ("\n", "\\par\n"), ("é", "\\'e9"), ("ü", "\\u252?")):
        rtf = F.replace(rtf, F.lit(old), F.lit(new))
    rtf = F.concat(F.lit("{\\rtf1\\ansi\\ansicpg1252{\\fonttbl\\f0 Arial;}{\\*\\generator x;}\\f0 "), rtf, F.lit("}"))
    text = F.col("text")
    content = (
        F.when(kind == 0, F.replace(text, F.lit("\n"), F.lit("\r\n")).cast("binary"))
        .when(kind == 1, rtf.cast("binary"))
        .when(kind == 2, F.concat(F.unhex(F.lit("FF")), text.cast("binary"), F.unhex(F.lit("C3"))))
        .when(kind == 4, F.replace(text, F.lit("\n"), F.lit("\r")).cast("binary"))
        .otherwise(text.cast("binary"))
    )
    return (
        _texts(spark, sf_dir)
        .select(
            "doc_id",
            F.concat(F.format_string("/corpus/%s/%06d", "source", "doc_id"), suffix).alias("path"),
            F.lit(None).cast("timestamp").alias("modificationTime"),
            content.alias("content"),
        )
        .withColumn("length", F.octet_length("content").cast("bigint"))
    )


def token_chunks(spark: SparkSession, sf_dir: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """The documents' chunks by tokens with their ids, staged."""
    with Scratch(spark):
        rows = staged_chunks(documents(spark, sf_dir), size, overlap)
        table = assign_chunk_ids(rows).select("chunk_id", "source_file", "text", "text_length", "token_count")
        return stage(table, "chunk-table", outer=True)
