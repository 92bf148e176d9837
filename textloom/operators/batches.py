"""Rows of one batch padded to one width, with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import let
from textloom.functions.tokens import pad_right
from textloom.operators.ids import dense_numbers
from textloom.operators.vocabulary import TokenizerSpec

IGNORED = -100  # the label a loss skips


#: Columns that number the rows 0, 1, 2, ... wherever this library makes them.
DENSE = ("chunk_id",)


def with_batches(df: DataFrame, order: str | Sequence[str], batch_size: int) -> DataFrame:
    """``batch_id``: rows in the order of a column or several, ``batch_size`` at a time.

    ``chunk_id`` numbers the rows already; by other columns, of any type, repeated or null, they are numbered first.
    """
    keys = [order] if isinstance(order, str) else list(order)
    if len(keys) == 1 and keys[0] in DENSE:
        return df.withColumn("batch_id", F.call_function("div", F.col(keys[0]), F.lit(batch_size)))
    return dense_numbers(df, keys, "batch_id").withColumn("batch_id", F.call_function("div", F.col("batch_id"), F.lit(batch_size)))


def _batch_width(multiple: int | None) -> Column:
    """The longest row of the batch, rounded up; a batch holds at most batch_size rows."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    if not multiple:
        return longest
    return F.call_function("div", longest + (multiple - 1), F.lit(multiple)).cast("int") * multiple


def pad_to_longest(
    df: DataFrame, order: str | Sequence[str], batch_size: int = 1000, pad_id: int = 0, pad_to_multiple_of: int | None = None
) -> DataFrame:
    """Right-pad ids and mask to the width of the row's batch; adds ``batch_id``."""
    return (
        with_batches(df, order, batch_size)
        .withColumn("_width", _batch_width(pad_to_multiple_of))
        .withColumns(
            {
                "input_ids": pad_right(F.col("input_ids"), F.col("_width"), pad_id),
                "attention_mask": pad_right(F.col("attention_mask"), F.col("_width"), 0),
            }
        )
        .drop("_width")
    )


def collate_causal_lm(
    df: DataFrame,
    order: str | Sequence[str] = "chunk_id",
    batch_size: int = 8,
    pad_id: int = 0,
    pad_to_multiple_of: int | None = None,
) -> DataFrame:
    """Padded batches with ``labels``: the ids, and -100 wherever the id is the pad id."""
    padded = pad_to_longest(df, order, batch_size, pad_id, pad_to_multiple_of)
    return padded.withColumn("labels", causal_labels(F.col("input_ids"), pad_id))


def causal_labels(ids: Column, pad_id: int) -> Column:
    return F.transform(ids, lambda x: F.when(x == pad_id, IGNORED).otherwise(x))


def _hex_below(share: float) -> str:
    """The 8 hex digits below which a share of all 8-digit strings lies."""
    return f"{min(int(share * 2**32), 2**32 - 1):08x}"


def mask_mlm(
    df: DataFrame,
    spec: TokenizerSpec,
    vocab_size: int,
    order: str = "chunk_id",
    probability: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Masked-model inputs: ``labels`` for the picked tokens, -100 elsewhere.

    Of the picked ones 80 % become the mask token, 10 % a random token, 10 % stay.
    The draw is a hash of seed, row and place, so a repeated task draws the same.
    """
    special = len(spec.special_tokens)
    mask_id = spec.special_id(spec.mask_token)
    pick, masked, randomized = _hex_below(probability), _hex_below(0.8), _hex_below(0.9)
    row = F.concat(F.lit(f"{seed}:"), F.col(order).cast("string"), F.lit(":"))

    def draw(token: Column, place: Column) -> Column:
        """(new id, label); eight hex digits each for the pick, the action and the random id."""
        kept = F.struct(token.alias("id"), F.lit(IGNORED).alias("label"))
        random_id = F.conv(F.substring(F.md5(F.concat(row, place.cast("string"))), 17, 8), 16, 10)

        def choose(h: Column) -> Column:
            action = F.substring(h, 9, 8)
            new = (
                F.when(action < masked, F.lit(mask_id))
                .when(action < randomized, (random_id.cast("bigint") % vocab_size).cast("int"))
                .otherwise(token)
            )
            return F.when(
                F.substring(h, 1, 8) < pick, F.struct(new.alias("id"), token.alias("label"))
            ).otherwise(kept)

        hashed = let(F.md5(F.concat(row, place.cast("string"))), choose)
        return F.when(token < special, kept).otherwise(hashed)

    return (
        df.withColumn("_drawn", F.transform("input_ids", draw))
        .withColumns({"input_ids": F.col("_drawn.id"), "labels": F.col("_drawn.label")})
        .drop("_drawn")
    )
