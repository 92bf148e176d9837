"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: after the first punctuation mark before a
blank that leaves ``MIN_CHUNK`` characters, at ``MAX_CHUNK`` at the latest. Distinct chunks
are gathered once and give the identifiers: a chunk's 64-bit hash, and its number among
the different chunks of that hash, so equal identifiers mean equal characters. A text's
recipe is its ordered identifiers, and texts are equal when their recipes are. Only
distinct chunks and recipes (8 bytes for some 500 characters) move, never whole texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace, texts_of

MIN_CHUNK, MAX_CHUNK = 512, 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks; put together they are the text. No chunk for an empty text."""
    pattern = rf"(?s).{{{least},{most - 1}}}?[.!?,;:](?=\s)|.{{1,{most}}}+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _hash(chunk: Column, bits: int) -> Column:
    whole = F.xxhash64(chunk)
    return whole if bits == 64 else whole.bitwiseAND(F.lit((1 << bits) - 1))


def _clashes(pieces: DataFrame) -> DataFrame:
    """``hash, chunk, number`` of the chunks whose hash stands for several: the verified identifiers."""
    known = pieces.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    several = known.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    number = F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
    return known.join(several, "hash").select("hash", "chunk", number.alias("number"))


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    least: int = MIN_CHUNK,
    most: int = MAX_CHUNK,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks`` and ``carry``.

    Texts are equal when identical after lowering A-Z. Null is empty, and empty texts are
    equal. Of equal texts the row with the largest id stays; of rows that repeat that id
    too, one of them. Null ids are smaller than all others; where a group has no other, its ``keep_id`` is
    null and one row stays. ``carry`` are further columns of ``docs`` that are handed on.
    ``hash_bits`` below 64 makes identifiers clash, for tests.
    """
    ws = Workspace(docs.sparkSession, "recipes")
    named = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        lowered(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_text"),
        F.struct(*[F.col(c) for c in carry]).alias("_carry") if carry else F.lit(None).cast("string").alias("_carry"),
    )
    cut = named.withColumn("_chunks", chunks_of(F.col("_text"), least, most))
    pieces = cut.select(F.explode("_chunks").alias("chunk")).select(_hash(F.col("chunk"), hash_bits).alias("hash"), "chunk")
    clashes = ws.stage(_clashes(pieces), "clashes")
    recipes = cut.select(
        "doc_id",
        "_carry",
        F.sha2(F.col("_text"), 256).alias("text_sha256"),
        F.transform("_chunks", lambda c: F.struct(_hash(c, hash_bits).alias("hash"), F.lit(0).alias("number"))).alias(
            "recipe"
        ),
    ).withColumn("_row", F.monotonically_increasing_id())
    recipes = ws.stage(recipes, "recipes")
    if not clashes.isEmpty():
        recipes = ws.stage(_numbered(recipes, cut, clashes, hash_bits), "numbered")
    recipes = recipes.withColumn("_hash", F.xxhash64("recipe"))
    groups = (
        recipes.groupBy("_hash", "recipe")
        .agg(F.max(F.struct("doc_id", "_row")).alias("_stays"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", "recipe", "_stays", "group_size")
    )
    joined = recipes.join(groups, ["_hash", "recipe"])
    out = joined.select(
        "doc_id",
        F.col("_stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_stays._row")).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
        *([F.col("_carry")[c].alias(c) for c in carry]),
    )
    return ws.finish(out)


def _numbered(recipes: DataFrame, cut: DataFrame, clashes: DataFrame, bits: int) -> DataFrame:
    """Recipes with the numbers of clashing chunks filled in; rows that agree in id and text share them."""
    placed = cut.select(
        "doc_id", F.sha2(F.col("_text"), 256).alias("text_sha256"), F.posexplode("_chunks").alias("place", "chunk")
    ).withColumn("hash", _hash(F.col("chunk"), bits))
    numbers = (
        placed.join(clashes, ["hash", "chunk"])
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
        .agg(F.map_from_entries(F.collect_set(F.struct("place", "number"))).alias("_numbers"))
    )
    same = [recipes["doc_id"].eqNullSafe(numbers["_id"]), recipes["text_sha256"] == numbers["_sha"]]
    filled = F.transform(
        "recipe",
        lambda c, i: F.struct(c["hash"].alias("hash"), F.coalesce(F.col("_numbers")[i], F.lit(0)).alias("number")),
    )
    return recipes.join(numbers, same, "left").withColumn("recipe", filled).drop("_id", "_sha", "_numbers")
