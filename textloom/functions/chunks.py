"""Sentences and chunks of one text, as column expressions.

Packing is greedy, so one text is folded from left to right inside its row and
texts run in parallel. A fold copies its state at every step, closed chunks
included, so the sentences are folded in blocks of blocks: each level hands only
the open chunk down and takes the newly closed ones back. A text of n sentences
then costs n**(4/3) instead of n**2, and a book in one row stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import WS, let, strip
from textloom.functions.tokens import decode, tokenize

# A sentence end, and the characters taken for one token.
SENTENCE_END = rf"[.!?]+(?:{WS}+|$)"
CHARS_PER_TOKEN = 4

SMALLEST_BLOCK = 32  # sentences; below this a block costs more than the copies it saves


def check_sizes(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"need size >= 1 and 0 <= overlap < size, got {size} and {overlap}")


def split_sentences(text: Column) -> Column:
    """Sentences without their end marks, trimmed; the text itself if nothing is left."""
    pieces = F.filter(F.transform(F.split(text, SENTENCE_END), strip), lambda s: s != "")
    return let(pieces, lambda p: F.when(F.size(p) == 0, F.array(text)).otherwise(p))


def _fold(items: Column, start: dict[str, Column], add: Callable[[Column, Column], Column]) -> Column:
    """Fold ``items`` from left to right over a state with the fields of ``start``.

    ``closed``, the first field, only grows; ``add`` sees it emptied at block starts.
    """

    def handed(state: Column) -> Column:
        rest = [state[name].alias(name) for name in list(start)[1:]]
        return F.struct(start["closed"].alias("closed"), *rest)

    def blocks(values: Column, width: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(values), width), lambda at: F.slice(values, at, width)
        )

    def through(step: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        def outer(state: Column, block: Column) -> Column:
            return let(
                F.aggregate(block, handed(state), step),
                lambda r: F.struct(
                    F.concat(state["closed"], r["closed"]).alias("closed"),
                    *[r[name].alias(name) for name in list(start)[1:]],
                ),
            )

        return outer

    first = F.struct(*[value.alias(name) for name, value in start.items()])

    def whole(values: Column) -> Column:
        width = F.greatest(F.ceil(F.cbrt(F.size(values))).cast("int"), F.lit(SMALLEST_BLOCK))
        return let(
            width, lambda w: F.aggregate(blocks(blocks(values, w), w), first, through(through(add)))
        )

    return let(items, whole)


def _last(values: Column, count: Column) -> Column:
    """The last ``count`` elements, or all of a shorter array."""
    return F.slice(values, F.greatest(F.size(values) - count + 1, F.lit(1)), count)


def chunk_by_characters(text: Column, size: int = 512, overlap: int = 50) -> Column:
    """Chunks of about ``4 * size`` characters as array<struct<text, token_count>>."""
    check_sizes(size, overlap)
    limit, keep = size * CHARS_PER_TOKEN, overlap * CHARS_PER_TOKEN

    start = {
        "closed": F.array().cast("array<string>"),
        "open": F.lit(None).cast("string"),
        "used": F.lit(0),
    }

    def add(state: Column, sentence: Column) -> Column:
        closed, opened, used = state["closed"], state["open"], state["used"]
        full = opened.isNotNull() & (used + F.length(sentence) > limit)
        carried = F.substring(opened, -keep, keep) if keep else F.lit(None).cast("string")
        carried_length = F.least(F.length(opened), F.lit(keep))
        return F.struct(
            F.when(full, F.concat(closed, F.array(opened))).otherwise(closed).alias("closed"),
            # concat_ws leaves out a null, so the first piece gets no blank before it.
            F.concat_ws(" ", F.when(full, carried).otherwise(opened), sentence).alias("open"),
            (F.when(full, carried_length).otherwise(used) + F.length(sentence) + 1).alias("used"),
        )

    texts = let(
        _fold(split_sentences(text), start, add), lambda s: F.concat(s["closed"], F.array(s["open"]))
    )
    return F.transform(
        texts,
        lambda t: F.struct(
            t.alias("text"),
            F.floor(F.length(t) / CHARS_PER_TOKEN).cast("int").alias("token_count"),
        ),
    )


def chunk_by_tokens(text: Column, size: int = 512, overlap: int = 50) -> Column:
    """Chunks of about ``size`` tokens as array<struct<text, token_count>>.

    A text that fits is one chunk. Otherwise sentences are packed; when that
    gives one chunk only, windows over the whole token list are cut instead.
    """
    check_sizes(size, overlap)

    def choose(tokens: Column) -> Column:
        return F.when(
            F.size(tokens) <= size, F.array(_chunk(text, F.size(tokens)))
        ).otherwise(
            let(
                pack_sentences(text, size, overlap),
                lambda packed: F.when(F.size(packed) > 1, packed).otherwise(
                    cut_windows(tokens, size, overlap)
                ),
            )
        )

    return let(tokenize(text), choose)


def _chunk(text: Column, count: Column) -> Column:
    return F.struct(text.alias("text"), count.cast("int").alias("token_count"))


def pack_sentences(text: Column, size: int, overlap: int) -> Column:
    """Greedy packing by each sentence's own token count; the overlap's tokens count too.

    The fold reads counts only. A chunk's tokens are the last ones of all tokens up
    to its end, so the overlap is cut out afterwards from the sentences before it.
    """
    start = {
        "closed": F.array().cast("array<struct<end:int,used:int>>"),
        "used": F.lit(0),
        "next": F.lit(0),
    }

    def end(state: Column) -> Column:
        return F.struct(state["next"].alias("end"), state["used"].alias("used"))

    def add(state: Column, count: Column) -> Column:
        full = (state["used"] > 0) & (state["used"] + count > size)
        closed = state["closed"]
        return F.struct(
            F.when(full, F.concat(closed, F.array(end(state)))).otherwise(closed).alias("closed"),
            (F.when(full, F.least(state["used"], F.lit(overlap))).otherwise(state["used"]) + count).alias("used"),
            (state["next"] + 1).alias("next"),
        )

    def texts(sentences: Column, tokens: Column, ends: Column) -> Column:
        def one(here: Column, k: Column) -> Column:
            begin = F.coalesce(F.get(ends, k - 1)["end"], F.lit(0))
            own = F.array_join(F.slice(sentences, begin + 1, here["end"] - begin), " ")
            if not overlap:
                return _chunk(own, here["used"])
            # Every sentence has a token, so this many sentences hold the overlap.
            length = F.least(F.get(ends, k - 1)["used"], F.lit(overlap))
            before = F.flatten(F.slice(tokens, F.greatest(begin - length, F.lit(0)) + 1, F.least(begin, length)))
            carried = F.when(k > 0, decode(_last(before, length)))
            return _chunk(F.concat_ws(" ", carried, own), here["used"])

        return F.transform(ends, one)

    def packed(sentences: Column) -> Column:
        return let(
            F.transform(sentences, tokenize),
            lambda tokens: let(
                let(
                    _fold(F.transform(tokens, F.size), start, add),
                    lambda s: F.concat(s["closed"], F.array(end(s))),
                ),
                lambda ends: texts(sentences, tokens, ends),
            ),
        )

    return let(split_sentences(text), packed)


def cut_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` tokens, each starting ``size - overlap`` after the one before."""
    step = size - overlap
    last = F.greatest(F.ceil((F.size(tokens) - size) / step).cast("int"), F.lit(0)) * step
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(step)),
        lambda at: let(F.slice(tokens, at + 1, size), lambda w: _chunk(decode(w), F.size(w))),
    )
