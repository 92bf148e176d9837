"""Documents to packed training sequences: filter, deduplicate, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return whole rows of
``docs``, every column as it was; rows with null ids or repeated ids are rows like any other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import minmax, packing, quality, recipes, winnow
from textloom.llm.queries import tokenizer_path
from textloom.llm.tables import Workspace, table

#: Of 140 values in 35 bands of 4, sets of similarity 0.8 share no band once in 100 million times.
NEAR_ROWS = 4
ORACLE_SQL = None


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a number each: decisions come back by number, whatever the ids are.

    Rows of Parquet files, which the stages' inputs are, have one already: their place in their file. Nothing is copied
    then. Other frames are written out with numbers.
    """
    number, file, place = (_free(docs, c) for c in ("_row", "_file", "_place"))
    try:
        located = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        rows = docs.withColumn(number, F.monotonically_increasing_id())
        return Workspace(docs.sparkSession, f"pipeline-{name}").stage(rows, "documents"), number
    # A row per file.
    files = located.select(file).distinct().coalesce(1).withColumn(number, F.monotonically_increasing_id())
    files = Workspace(docs.sparkSession, f"pipeline-{name}").stage(files, "files")
    rows = located.join(F.broadcast(files), file).withColumn(number, F.shiftleft(number, 40) + F.col(place))
    return rows.drop(file, place), number


def _only(docs: DataFrame, number: str, kept: DataFrame) -> DataFrame:
    return docs.join(kept, number, "left_semi").drop(number)


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    good = quality.quality_filter(docs, table(spark, sf_dir, "labels"))
    return docs.where(good)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lowered) the row with the largest id stays."""
    rows, number = _numbered(docs, "exact")
    kept = recipes.exact_duplicates(rows, carry=[number]).where("kept").select(number)
    return _only(rows, number, kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by 5-word shingles of similarity 0.8 or more, directly or not, one stays."""
    rows, number = _numbered(docs, "near")
    kept = minmax.near_duplicates(rows, key=number, rows=NEAR_ROWS).where("kept").select(F.col("doc_id").alias(number))
    return _only(rows, number, kept)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    rows, number = _numbered(docs, "benchmark")
    found = winnow.decontaminate(rows, table(spark, sf_dir, "benchmark"), key=number)
    return _only(rows, number, found.where("NOT contaminated").select(F.col("doc_id").alias(number)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their ids, their sequence and their place in it."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    ws = Workspace(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.stage(stage(spark, docs, sf_dir), name)
        if i:
            ws.drop(STAGES[i - 1][0])  # read for the last time
    return docs
