"""Chunk tables: one row per chunk, with ids that run over all documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.chunks import chunk_by_characters, chunk_by_tokens
from textloom.functions.text import is_blank
from textloom.operators.ids import running_offsets
from textloom.sources.datasets import write_dataset
from textloom.sources.staging import stage

CHUNKERS = {"tokens": chunk_by_tokens, "characters": chunk_by_characters}
CHUNK_SCHEMA = (
    "text string, source_file string, chunk_id bigint, text_length int, token_count int, "
    "processing_timestamp timestamp"
)
CHUNK_COLUMNS = ["text", "source_file", "chunk_id", "text_length", "token_count", "processing_timestamp"]


def with_chunks(df: DataFrame, size: int = 512, overlap: int = 50, by: str = "tokens") -> DataFrame:
    """Replace ``text`` by ``chunks``; null for a blank text. Row by row, so streams can use it."""
    if by not in CHUNKERS:
        raise ValueError(f"chunk by one of {sorted(CHUNKERS)}, got {by!r}")
    chunks = F.when(~is_blank(F.col("text")), CHUNKERS[by](F.col("text"), size, overlap))
    return df.withColumn("chunks", chunks).drop("text")


def explode_chunks(df: DataFrame) -> DataFrame:
    """One row per chunk with ``pos`` inside its document and the document's ``num_chunks``.

    The outer form with a test on ``pos`` drops the same rows as the inner one, but
    keeps the optimizer from testing the array's size first, which would chunk twice.
    """
    kept = [c for c in df.columns if c != "chunks"]
    sized = df.withColumn("num_chunks", F.size("chunks"))
    return (
        sized.select(*kept, "num_chunks", F.posexplode_outer("chunks").alias("pos", "chunk"))
        .where(F.col("pos").isNotNull())
        .select(
            *kept,
            "pos",
            "num_chunks",
            F.col("chunk.text").alias("text"),
            F.length("chunk.text").alias("text_length"),
            F.col("chunk.token_count").alias("token_count"),
        )
    )


def chunk_text(df: DataFrame, size: int = 512, overlap: int = 50, by: str = "tokens") -> DataFrame:
    return explode_chunks(with_chunks(df, size, overlap, by))


def chunk_offsets(rows: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """``keys`` with the ``first_id`` of each document: documents in key order, ids without gaps.

    Reads only the keys and counts of each document's first chunk, so hand in a staged table.
    """
    return running_offsets(rows.where("pos = 0").select(*keys, "num_chunks"), keys, "num_chunks")


# Offsets within these bounds may be sent to every executor, by way of the driver; more of them are joined.
MAX_SENT_OFFSETS, MAX_SENT_KEY_BYTES = 500_000, 32 * 1024 * 1024


def assign_chunk_ids(rows: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Add ``chunk_id`` to staged chunk rows. The keys name a document.

    The chunks meet their document's offset in one join; whether the offsets are
    small enough to be sent to every executor is left to the measured size. That is the size
    of compressed files, of which names take little, so beyond the bounds they are not sent.
    """
    names = {key: f"_of_{key}" for key in keys}
    length = sum((F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) for key in keys), F.lit(0))
    size = rows.where("pos = 0").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("b")).first()
    offsets = chunk_offsets(rows, keys).withColumnsRenamed(names)
    if size["n"] > MAX_SENT_OFFSETS or size["b"] > MAX_SENT_KEY_BYTES:
        offsets = offsets.hint("merge")
    # A null key is a key like any other: its chunks are numbered too.
    same = [rows[key].eqNullSafe(offsets[name]) for key, name in names.items()]
    joined = rows.join(offsets, same)
    return joined.withColumn("chunk_id", F.col("first_id") + F.col("pos")).drop("first_id", *names.values())


def create_dataset(
    df: DataFrame,
    size: int = 512,
    overlap: int = 50,
    by: str = "tokens",
    keys: Sequence[str] = ("source_file",),
) -> DataFrame:
    """The chunk table of all documents; an error when there is no chunk."""
    extra = [] if "source_file" in keys else ["source_file"]
    rows = assign_chunk_ids(staged_chunks(df, size, overlap, by, keys, *extra), keys)
    return rows.withColumn("processing_timestamp", F.current_timestamp()).select(*CHUNK_COLUMNS)


def staged_chunks(
    df: DataFrame, size: int = 512, overlap: int = 50, by: str = "tokens",
    keys: Sequence[str] = ("source_file",), *more: str,
) -> DataFrame:
    """Chunk rows of the non-empty documents as a table; an error when there is none."""
    columns = list(dict.fromkeys([*keys, *more, "text"]))
    # Empty texts give no chunk anyway; a filter here would repeat what computes the text.
    given = df.select(*columns)
    if "source_file" in columns:
        given = given.na.fill("unknown", ["source_file"])
    rows = stage(chunk_text(given, size, overlap, by), "chunks")
    if rows.isEmpty():
        raise ValueError("No chunks created from cleaned data")
    return rows


def format_and_save(
    df: DataFrame, output_dir: str, fmt: str = "jsonl", split_name: str | None = None, **chunking
) -> str:
    return write_dataset(create_dataset(df, **chunking), output_dir, fmt, split_name=split_name)
