"""Best-fit packing of documents into sequences of a fixed number of tokens.

A length is at most the capacity, so the whole corpus is described by one count per
length. The packing is worked out on these counts: pieces above a third of the capacity
meet at most twice in a sequence and are matched greedily, the largest with the largest
that fits; smaller pieces then go, longest first, into the smallest gap that holds them.
Equal steps are taken together, so the plan is a list of runs: "of length L, the pieces
numbered a to b go to the sequences from s on, at offset o". Each piece gets its
number among the pieces of its length (a task's own count plus the counts of the tasks
before it) and looks up its run. No piece moves to be packed.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace, texts_of
from textloom.llm.tokens import Encoder, blank_pieces, text_slices

CAPACITY = 4096
END_ID = 1

#: length, first number, pieces, first sequence, offset, pieces in each sequence
Run = tuple[int, int, int, int, int, int]


class _Gaps:
    """Open sequences by the room they have left: runs of consecutive sequence numbers."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.runs:
                bisect.insort(self.sizes, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def take(self, least: int, most: int) -> tuple[int, int, int] | None:
        """``gap, first, count`` of up to ``most`` sequences with the smallest gap that is large enough."""
        place = bisect.bisect_left(self.sizes, least)
        if place == len(self.sizes):
            return None
        gap = self.sizes[place]
        first, count = self.runs[gap].pop()
        if count > most:
            self.runs[gap].append((first + most, count - most))
            count = most
        elif not self.runs[gap]:
            del self.runs[gap]
            del self.sizes[place]
        return gap, first, count


def plan_packing(counts: dict[int, int], capacity: int) -> list[Run]:
    """The runs that place ``counts[length]`` pieces of each length; work grows with the lengths, not the pieces."""
    runs: list[Run] = []
    gaps, sequences = _Gaps(), 0
    left, used = dict(counts), dict.fromkeys(counts, 0)

    def place(length: int, pieces: int, first: int, offset: int, each: int) -> None:
        runs.append((length, used[length], pieces, first, offset, each))
        used[length] += pieces
        left[length] -= pieces

    large = sorted(length for length in counts if 3 * length > capacity)
    for length in reversed(large):
        while left[length]:
            fit = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while fit >= 0 and left[large[fit]] == 0:
                fit -= 1
            if fit < 0 or large[fit] == length and left[length] == 1:
                partner = next((x for x in reversed(large[: max(fit, 0)]) if left[x] and x + length <= capacity), None)
            else:
                partner = large[fit]
            if partner is None:
                count = left[length]
                place(length, count, sequences, 0, 1)
            elif partner == length:
                count = left[length] // 2
                place(length, count, sequences, 0, 1)
                place(length, count, sequences, length, 1)
            else:
                count = min(left[length], left[partner])
                place(length, count, sequences, 0, 1)
                place(partner, count, sequences, length, 1)
            gaps.add(capacity - length - (partner or 0), sequences, count)
            sequences += count
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[length]:
            found = gaps.take(length, left[length])
            if found is None:
                each = capacity // length
                count = max(1, left[length] // each)
                gap, first = capacity, sequences
                sequences += count
            else:
                gap, first, count = found
                each = gap // length
            # As many whole sequences as there are pieces for; a last one takes the rest.
            whole = min(count, left[length] // each)
            if whole == 0:
                each, whole = left[length], 1
            gaps.add(gap, first + whole, count - whole)
            place(length, whole * each, first, capacity - gap, each)
            gaps.add(gap - each * length, first, whole)
    return runs


def _pieces(encoded: list[np.ndarray], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece: its document's place in the list, its number in the document, its length."""
    sizes = np.array([len(ids) for ids in encoded], np.int64)
    pieces = -(-sizes // capacity)
    document = np.repeat(np.arange(len(encoded)), pieces)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return document, piece, np.minimum(sizes[document] - piece * capacity, capacity)


def _counted(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each piece's number among the pieces of its length; ``seen`` counts on."""
    order = np.argsort(length, kind="stable")
    ranked = length[order]
    number = np.empty(len(length), np.int64)
    number[order] = seen[ranked] + np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
    seen += np.bincount(length, minlength=len(seen))
    return number


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool, plain_specials: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, slot, number`` and ``ids``: ``number`` counts a length within its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, blank_pieces, plain_specials)
        slot = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                encoded = encoder.encode(part.column("text"), end_id)
                document, piece, length = _pieces(encoded, capacity)
                start = piece * capacity
                own = zip(document.tolist(), start.tolist(), (start + length).tolist(), strict=True)
                crcs = [zlib.crc32(encoded[d][a:b]) for d, a, b in own]
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(document)), "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crcs, pa.int64()),
                    "slot": pa.array(np.full(len(piece), slot, np.int32)), "number": pa.array(_counted(length, seen)),
                }
                if with_ids:
                    # Pieces follow each other as their ids do.
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    ids = np.concatenate(encoded).view(np.int32) if encoded else np.empty(0, np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, slot int, number bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if wanted, ``ids``.

    A document's ids end with ``end_id``. Only documents above ``capacity`` are cut; null and empty
    texts are the end id alone. Null and repeated ids are documents like any other. Pieces
    of equal length are exchangeable: which of them gets which place follows the tasks'
    order, and any choice is an equally good packing. ``with_ids`` adds each piece's
    ids, so that a sequence is its pieces' ids by ``offset``.
    """
    ws = Workspace(docs.sparkSession, "packing")
    pieces = ws.stage(pieces_of(texts_of(docs, key, text), tokenizer, capacity, end_id, with_ids), "pieces")
    # A row per task and length: at most ``capacity`` rows a task.
    counts = pieces.groupBy("slot", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("slot", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = np.array(sorted(plan_packing(totals, capacity)), np.int64).reshape(-1, 6)
    sent = docs.sparkSession.sparkContext.broadcast(plan)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length, number):
        import pandas as pd

        runs = sent.value
        length, number = length.to_numpy(), number.to_numpy()
        # Runs are sorted by length and first number; a piece's run is the last that does not start behind it.
        own = runs[np.searchsorted((runs[:, 0] << 44) + runs[:, 1], (length << 44) + number, side="right") - 1]
        inside = number - own[:, 1]
        return pd.DataFrame({"sequence_id": own[:, 3] + inside // own[:, 5], "offset": own[:, 4] + inside % own[:, 5] * length})

    numbered = pieces.join(bases, ["slot", "length"]).withColumn("place", placed("length", F.col("number") + F.col("base")))
    more = ["ids"] if with_ids else []
    return ws.finish(
        numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset", *more)
    )
