"""Texts to token ids."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.tokens import pad_right, tokenize, truncate_ids
from textloom.operators.batches import pad_to_longest
from textloom.operators.vocabulary import DEFAULT_SPEC, TokenizerSpec
from textloom.sources.staging import stage

# A vocabulary within these bounds is sent to every executor. Of a larger one only its head is: so many of
# the most frequent tokens, none of them longer.
MAX_SENT_TOKENS = 1_000_000
MAX_SENT_BYTES = 64 * 1024 * 1024
HEAD_TOKENS = 200_000
HEAD_TOKEN_BYTES = 256

_PARTIAL = pa.struct([("ids", pa.list_(pa.int32())), ("tail", pa.list_(pa.string()))])


def fits_broadcast(vocabulary: DataFrame) -> bool:
    """Whether the vocabulary's measured size is within the bounds above."""
    size = vocabulary.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("b")
    ).first()
    return size["n"] <= MAX_SENT_TOKENS and size["b"] <= MAX_SENT_BYTES


def vocabulary_head(vocabulary: DataFrame, tokens: int = HEAD_TOKENS) -> DataFrame:
    """The most frequent tokens, without frequencies those of the smallest ids; at most ``tokens * HEAD_TOKEN_BYTES`` bytes."""
    short = vocabulary.where(F.octet_length("token") <= HEAD_TOKEN_BYTES)
    order = [F.desc("freq"), "id"] if "freq" in vocabulary.columns else ["id"]
    return short.orderBy(*order).limit(tokens)


class _Sent:
    """A sent table of tokens and ids; a worker makes its dictionary once."""

    _last: tuple[object, dict[str, int]] = (None, {})

    def __init__(self, table: DataFrame):
        rows = table.select("token", "id").toArrow()
        self.sent = table.sparkSession.sparkContext.broadcast((rows["token"].combine_chunks(), rows["id"].combine_chunks()))

    def ids_of(self, tokens: pa.Array, missing: int) -> np.ndarray:
        rows = self.sent.value
        if _Sent._last[0] is not rows:
            _Sent._last = (rows, dict(zip(rows[0].to_pylist(), rows[1].to_pylist(), strict=True)))
        known = _Sent._last[1]
        return np.fromiter((known.get(token, missing) for token in tokens.to_pylist()), np.int32, len(tokens))


def _partial_ids(tokens: pa.Array, sent: _Sent) -> pa.Array:
    """Per row its ids, and its distinct tokens that were not sent: the n-th of them stands as -n."""
    flat = tokens.flatten().dictionary_encode()
    place, words = flat.indices.to_numpy(), flat.dictionary
    ids = sent.ids_of(words, -1)[place]
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    row = np.repeat(np.arange(len(tokens)), sizes)
    unknown = np.flatnonzero(ids < 0)
    distinct, inverse = np.unique(row[unknown] * max(len(words), 1) + place[unknown], return_inverse=True)
    owner = distinct // max(len(words), 1)
    number = np.arange(len(distinct)) - np.searchsorted(owner, owner)
    ids[unknown] = -1 - number[inverse]

    def listed(values: pa.Array, counts: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)

    tail = words.take(pa.array(distinct % max(len(words), 1)))
    return pa.StructArray.from_arrays(
        [listed(pa.array(ids), sizes), listed(tail, np.bincount(owner, minlength=len(tokens)))], fields=list(_PARTIAL)
    )


def _lookup(table: DataFrame):
    """A column function from tokens to ``ids, tail``; the table's size is bounded by its caller."""
    sent = _Sent(table)

    @F.arrow_udf("struct<ids:array<int>,tail:array<string>>")
    def lookup(tokens: pa.Array) -> pa.Array:
        return _partial_ids(tokens, sent)

    return lookup


def _completed(ids: Column, found: Column, unk_id: int) -> Column:
    return F.transform(ids, lambda x: F.when(x >= 0, x).otherwise(F.coalesce(found[-x], F.lit(unk_id))))


def encode_tokens(
    df: DataFrame,
    vocabulary: DataFrame,
    keys: Sequence[str],
    spec: TokenizerSpec = DEFAULT_SPEC,
    text_column: str = "text",
    broadcast: bool | None = None,
    head_tokens: int = HEAD_TOKENS,
    keep_text: bool = True,
) -> DataFrame:
    """Add ``input_ids``. Every row is encoded on its own, also where ``keys`` repeat or are null.

    The usual vocabulary is bounded and looked up in Arrow batches, so no row moves. Of one beyond the bounds
    only the head is looked up so. What is left of a row, its distinct tokens that are not in the head, is
    joined with the vocabulary and comes back by the row's number; rows without such tokens move nowhere.
    Numbers are written down with the rows first, so that a lost executor cannot change them.
    """
    tokens = tokenize(F.coalesce(F.col(text_column), F.lit("")))
    given = [c for c in df.columns if keep_text or c != text_column]
    if broadcast is None:
        vocabulary = stage(vocabulary, "vocabulary")
        broadcast = fits_broadcast(vocabulary)
    unknown = F.lit(spec.unk_id)
    if broadcast:
        ids = F.transform(_lookup(vocabulary)(tokens)["ids"], lambda x: F.when(x >= 0, x).otherwise(unknown))
        return df.withColumn("input_ids", _with_ends(ids, spec)).select(*[c for c in given if c != "input_ids"], "input_ids")
    row, part, found = free_names(df, "_row", "_part", "_found")
    given = [c for c in given if c != "input_ids"]
    head = _lookup(vocabulary_head(vocabulary, head_tokens))
    parts = df.withColumns({row: F.monotonically_increasing_id(), part: head(tokens)}).select(
        *given, row, F.col(part)["ids"].alias(part), F.col(part)["tail"].alias(found), (F.size(F.col(part)["tail"]) > 0).alias("_more")
    )
    parts = stage(parts, "encode")
    rest = (
        parts.where("_more").select(row, F.posexplode(found).alias("_pos", "token"))
        .join(vocabulary.select("token", "id"), "token")
        .groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_pos") + 1, "id"))).alias("_ids"))
    )
    open_rows = parts.where("_more").join(rest, row, "left").select(
        *given, _completed(F.col(part), F.coalesce("_ids", F.create_map().cast("map<int,int>")), spec.unk_id).alias(part)
    )
    whole = parts.where("NOT _more").select(*given, part).unionByName(open_rows)
    return whole.select(*given, _with_ends(F.col(part), spec).alias("input_ids"))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The names, with as many underscores behind them as it takes to clash with no column."""
    out = []
    for name in wanted:
        while name in df.columns:
            name += "_"
        out.append(name)
    return out


def _with_ends(ids: Column, spec: TokenizerSpec) -> Column:
    parts = [ids]
    if spec.add_bos:
        parts.insert(0, F.array(F.lit(spec.special_id(spec.bos_token))))
    if spec.add_eos:
        parts.append(F.array(F.lit(spec.special_id(spec.eos_token))))
    return F.concat(*parts) if len(parts) > 1 else ids


def encode_dataset(
    df: DataFrame,
    vocabulary: DataFrame,
    keys: Sequence[str] = ("chunk_id",),
    spec: TokenizerSpec = DEFAULT_SPEC,
    text_column: str = "text",
    max_length: int | None = None,
    truncation: bool = True,
    padding: bool = False,
    padding_style: str = "max_length",
    return_attention_mask: bool = True,
    batch_size: int = 1000,
) -> DataFrame:
    """Replace the text column by ``input_ids`` and ``attention_mask``; other columns stay."""
    if text_column not in df.columns:
        raise ValueError(f"Column '{text_column}' not found in dataset. Available: {df.columns}")
    max_length = max_length or spec.model_max_length
    encoded = encode_tokens(df, vocabulary, keys, spec, text_column, keep_text=False)
    if truncation and max_length:
        encoded = encoded.withColumn("input_ids", truncate_ids(F.col("input_ids"), max_length))
    encoded = encoded.withColumn("attention_mask", attention_mask(F.col("input_ids")))
    if padding and max_length and padding_style == "max_length":
        encoded = pad_to_max_length(encoded, max_length, spec.pad_id)
    elif padding:
        encoded = pad_to_longest(encoded, keys, batch_size, spec.pad_id)
    return encoded if return_attention_mask else encoded.drop("attention_mask")


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def pad_to_max_length(df: DataFrame, max_length: int, pad_id: int) -> DataFrame:
    width = F.lit(max_length)
    return df.withColumns(
        {
            "input_ids": pad_right(F.col("input_ids"), width, pad_id),
            "attention_mask": pad_right(F.col("attention_mask"), width, 0),
        }
    )


def prepare_for_training(
    df: DataFrame,
    vocabulary: DataFrame | None = None,
    keys: Sequence[str] = ("chunk_id",),
    spec: TokenizerSpec = DEFAULT_SPEC,
    text_column: str = "text",
    max_length: int | None = None,
    pre_tokenized: bool = False,
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` only; an already tokenized table is returned as it is."""
    if pre_tokenized:
        if "input_ids" not in df.columns:
            raise ValueError(
                "Dataset marked as pre-tokenized but 'input_ids' column not found. "
                f"Available columns: {', '.join(df.columns)}"
            )
        return df
    encoded = encode_dataset(df, vocabulary, keys, spec, text_column, max_length)
    return encoded.select("input_ids", "attention_mask")
