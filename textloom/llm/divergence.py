"""How far the sources of a language drift apart in their terms: single-pass in-memory indexing, then pair corrections.

A task reads its documents once and builds postings in memory: per language the terms of each document with their counts. When memory is full the block is spilled as a run: its terms in order, cut into hash shards and these into
short slices. A shard's slices arrive ordered by their first term and are merged with a heap, which holds a few slices a run,
whatever the shard's size. Out come, term by term, the postings of the whole corpus.

A source that lacks a term gives it the same share as every other term it lacks. So the divergence of two sources over all
kept terms is that of two such shares times the number of terms, corrected for the terms that either has (by how often
the source has how many of them, not term by term), and for the terms that both have. Only the last are pairs of postings;
they are summed in the task that meets them. All of it is in integers.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Terms of documents a task holds before it spills a run, and postings it holds before it sums what is complete.
BLOCK_POSTINGS, MERGED_POSTINGS = 3 << 20, 1 << 18
#: Terms in a slice of a run.
SLICE_TERMS = 1 << 10
#: Bytes of a text that are cut into words at once.
_PIECE = 1 << 20
#: Pairs of postings that are compared at once, and sums of pairs of sources that a task holds.
_PAIRS, _SUMS = 1 << 20, 1 << 18

# Fixed value: letters, lowered where they are ASCII, and every byte of a character beyond ASCII; the rest parts words.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in portions of bounded size."""
    start = 0
    while start < len(text):
        stop = start + _PIECE
        piece = text[start:stop].translate(_LETTERS)
        if stop < len(text) and not piece.endswith(b" "):
            # The last word goes on: it is left to the next piece, unless it is all there is.
            cut = piece.rfind(b" ") + 1
            if cut == 0:
                while stop < len(text) and _LETTERS[text[stop]] != 0x20:
                    stop += 1
                piece = text[start:stop].translate(_LETTERS)
            else:
                piece, stop = piece[:cut], start + cut
        yield piece.split()
        start = stop


class _Language:
    """A block's documents in one language: each of their terms by number, source and count."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.sources: defaultdict[str, int] = defaultdict(count().__next__)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, source: str, text: bytes) -> int:
        portions = words_of(text)
        own = Counter(next(portions, ()))
        for words in portions:
            own.update(words)
        numbers = np.fromiter(map(self.numbers.__getitem__, own), np.int32, len(own))
        counts = np.fromiter(own.values(), np.int64, len(own))
        self.parts.append((numbers, np.full(len(own), self.sources[source], np.int32), counts))
        return len(own)


def _lists(values: pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)


def _slices(lang: str, block: _Language, run: int, shards: int) -> pa.RecordBatch | None:
    """A language's part of a run: per shard its terms in order, cut into slices."""
    if not block.numbers:
        return None
    number, source, times = (np.concatenate([part[i] for part in block.parts]) for i in range(3))
    documents = np.bincount(number, minlength=len(block.numbers))
    terms = pa.array(list(block.numbers), pa.binary())
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    shard = np.fromiter((zlib.crc32(term) % shards for term in block.numbers), np.int64, len(terms))
    order = np.lexsort((rank, shard))
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    # Occurrences of a term in a source, over all documents, in the order of the terms.
    key = place[number] * len(block.sources) + source
    by_key = np.argsort(key, kind="stable")
    key = key[by_key]
    firsts = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[firsts], np.add.reduceat(times[by_key], firsts)
    sizes = np.bincount(key // len(block.sources), minlength=len(terms))
    starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    begins = np.concatenate([np.arange(low, high, SLICE_TERMS) for low, high in zip(starts, [*starts[1:], len(terms)], strict=True)])
    ends = np.append(begins[1:], len(terms))
    terms, postings = terms.take(pa.array(order)), np.cumsum(sizes)
    names = pa.array(list(block.sources) * len(begins), pa.string())
    columns = {
        "shard": pa.array(shard[order[begins]].astype(np.int32)), "lang": pa.array([lang] * len(begins), pa.string()),
        "first": terms.take(pa.array(begins)), "run": pa.array(np.full(len(begins), run)),
        "sources": _lists(names, np.arange(1, len(begins) + 1) * len(block.sources)), "terms": _lists(terms, ends),
        "documents": _lists(pa.array(documents[order]), ends), "sizes": _lists(pa.array(sizes.astype(np.int32)), ends),
        "source": _lists(pa.array((key % len(block.sources)).astype(np.int32)), postings[ends - 1]),
        "count": _lists(pa.array(times), postings[ends - 1]),
    }
    return pa.RecordBatch.from_pydict(columns)


def spilled_runs(docs: DataFrame, shards: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Slices of the runs of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[str, _Language] = {}
        number, held = TaskContext.get().partitionId() << 32, 0

        def spilled() -> Iterator[pa.RecordBatch]:
            for lang, own in sorted(block.items()):
                out = _slices(lang, own, number, shards)
                for start in range(0, out.num_rows if out else 0, 32):
                    yield out.slice(start, 32)

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(langs, sources, texts, strict=True):
                if lang not in block:
                    block[lang] = _Language()
                held += block[lang].add(source, text.as_py())
                if held >= block_postings:
                    yield from spilled()
                    block, number, held = {}, number + 1, 0
        yield from spilled()

    return docs.select("lang", "source", "text").mapInArrow(
        run,
        "shard int, lang string, first binary, run bigint, sources array<string>, terms array<binary>, documents array<bigint>, "
        "sizes array<int>, source array<int>, count array<bigint>",
    )


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


class _Slice:
    """A slice of a run, read up to ``at``."""

    def __init__(self, batch: pa.RecordBatch, row: int, sources: Callable[[str], int]):
        own = {name: batch.column(name)[row].values for name in ("sources", "terms", "documents", "sizes", "source", "count")}
        self.terms, self.documents, self.sizes = own["terms"], own["documents"].to_numpy(), own["sizes"].to_numpy()
        known = np.fromiter(map(sources, own["sources"].to_pylist()), np.int64, len(own["sources"]))
        self.source, self.count = known[own["source"].to_numpy()], own["count"].to_numpy()
        self.ends, self.at = np.concatenate([[0], np.cumsum(self.sizes)]), 0

    def upto(self, bound: bytes | None) -> int:
        """Place of the first term that is not below ``bound``."""
        low, high = self.at, len(self.terms)
        while bound is not None and low < high:
            middle = (low + high) // 2
            if self.terms[middle].as_py() < bound:
                low = middle + 1
            else:
                high = middle
        return high

    def take(self, stop: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        begin, self.at = self.at, stop
        low, high = self.ends[begin], self.ends[stop]
        return (
            self.terms.slice(begin, stop - begin), self.documents[begin:stop], self.sizes[begin:stop],
            self.source[low:high], self.count[low:high],
        )


def _summed(parts: list[tuple], least: int, names: list[str], lang: str) -> pa.RecordBatch:
    """``lang, term, total, postings`` of the terms of several slices, ordered by term."""
    terms = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    code = terms.indices.to_numpy()
    documents = np.bincount(code, np.concatenate([p[1] for p in parts])).astype(np.int64)
    key = np.repeat(code, np.concatenate([p[2] for p in parts])).astype(np.int64) * len(names) + np.concatenate([p[3] for p in parts])
    order = np.argsort(key, kind="stable")
    key = key[order]
    firsts = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(np.concatenate([p[4] for p in parts])[order], firsts)
    code, source = key[firsts] // len(names), key[firsts] % len(names)
    good = documents[code] >= least
    code, source, times = code[good], source[good], times[good]
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    values = pa.StructArray.from_arrays([pa.array(names, pa.string()).take(pa.array(source)), pa.array(times)], ["source", "count"])
    total = np.add.reduceat(times, starts) if len(starts) else np.empty(0, np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang] * len(starts), pa.string()), "term": pc.cast(
                terms.dictionary.take(pa.array(code[starts])), options=pc.CastOptions(pa.string(), allow_invalid_utf8=True)
            ),
            "total": pa.array(total), "postings": _lists(values, np.append(starts, len(code))[1:]),
        }
    )


def merged(batches: Iterable[pa.RecordBatch], least: int, at_once: int = MERGED_POSTINGS) -> Iterator[pa.RecordBatch]:
    """Terms with their postings, of slices ordered by shard, language and first term.

    The heap holds the open slices by the term that each is at. Terms below the first of the slice that comes next are
    complete; when enough postings are held, they are taken from all slices that have such terms.
    """
    heap: list[tuple[bytes, int, _Slice]] = []
    sources: defaultdict[str, int] = defaultdict(count().__next__)
    held = opened = 0
    at = None

    def complete(bound: bytes | None) -> pa.RecordBatch:
        nonlocal held
        parts, rest = [], []
        while heap and (bound is None or heap[0][0] < bound):
            _, number, own = heapq.heappop(heap)
            parts.append(own.take(own.upto(bound)))
            held -= len(parts[-1][3])
            if own.at < len(own.terms):
                rest.append((own.terms[own.at].as_py(), number, own))
        for item in rest:
            heapq.heappush(heap, item)
        return _summed(parts, least, list(sources), at[1])

    for batch in batches:
        groups = list(zip(batch.column("shard").to_pylist(), batch.column("lang").to_pylist(), strict=True))
        for row, (group, first) in enumerate(zip(groups, batch.column("first").to_pylist(), strict=True)):
            if heap and group != at:
                yield complete(None)
            elif held >= at_once and heap[0][0] < first:
                yield complete(first)
            if group != at:
                sources.clear()
                sources.default_factory = count().__next__
            at, opened = group, opened + 1
            own = _Slice(batch, row, sources.__getitem__)
            held += len(own.count)
            heapq.heappush(heap, (first, opened, own))
    if heap:
        yield complete(None)


def kept_terms(runs: DataFrame, shards: int, least: int = LEAST_DOCUMENTS, at_once: int = MERGED_POSTINGS) -> DataFrame:
    """``lang, term, total, postings`` of the terms that stand in at least ``least`` documents of their language."""
    ordered = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first", "run")
    return ordered.mapInArrow(
        lambda batches: merged(batches, least, at_once), "lang string, term string, total bigint, postings array<struct<source:string,count:bigint>>"
    )


def _share(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)``, beyond 64 bits on the way."""
    return (F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(12,0)"), total.cast("decimal(20,0)")) + 1).cast("bigint")


def _drift(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _co_posted(lists: DataFrame, at_once: int = _PAIRS) -> DataFrame:
    """``a, b, value``: what pairs of sources that share a term add to their drift beyond what each adds alone."""

    def of(sources: np.ndarray, p: np.ndarray, p0: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        firsts = np.cumsum(sizes) - sizes
        each = np.repeat(sizes, sizes)
        a = np.repeat(np.arange(len(sources)), each)
        b = np.repeat(np.repeat(firsts, sizes), each) + _within(each)
        return a, b, _f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}

        def flushed() -> pa.RecordBatch:
            pairs = list(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64()), pa.array(list(sums.values()), pa.int64())],
                ["a", "b", "value"],
            )

        def add(sources: np.ndarray, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> None:
            known, own = np.unique(sources, return_inverse=True)
            key = own[a] * len(known) + own[b]
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            for k, total in zip(key[starts].tolist(), np.add.reduceat(value, starts).tolist(), strict=True):
                pair = (int(known[k // len(known)]), int(known[k % len(known)]))
                sums[pair] = sums.get(pair, 0) + total

        for batch in batches:
            column = batch.column("sharing")
            sizes = column.value_lengths().to_numpy()
            flat = column.flatten()
            sources, p, p0 = (flat.field(name).to_numpy() for name in ("number", "p", "p0"))
            ends, begin = np.cumsum(sizes), 0
            squares = np.cumsum(sizes.astype(np.int64) ** 2)
            while begin < len(sizes):
                paid = squares[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(squares, paid + at_once, "right")))
                low, high = int(ends[begin] - sizes[begin]), int(ends[stop - 1])
                if stop == begin + 1 and sizes[begin] ** 2 > at_once:
                    # A term of very many sources: some of its rows at a time against all of them.
                    step = max(1, at_once // int(sizes[begin]))
                    for one in range(low, high, step):
                        mine = np.arange(one, min(one + step, high))
                        a, b = np.repeat(mine, high - low), np.tile(np.arange(low, high), len(mine))
                        value = _f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b])
                        add(sources, a, b, value)
                        if len(sums) > _SUMS:
                            yield flushed()
                            sums.clear()
                else:
                    part = slice(low, high)
                    add(sources[part], *of(sources[part], p[part], p0[part], sizes[begin:stop]))
                if len(sums) > _SUMS:
                    yield flushed()
                    sums.clear()
                begin = stop
        if sums:
            yield flushed()

    return lists.select("sharing").mapInArrow(run, "a bigint, b bigint, value bigint")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS, shards: int | None = None, block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: per source its drift from each other source of the language (part ``pair``)
    and the kept terms it has above the language's share (part ``term``, the ``top`` first).

    Null texts, languages and sources are empty ones. A language keeps the terms of at least ``least`` of its documents; one without
    any still has its pairs, with value 0. Rows count one by one, whatever other columns say; an empty table gives no rows.
    Equal values rank by the item's bytes.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "divergence")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    )
    runs = ws.stage(spilled_runs(given, shards, block_postings), "runs")
    terms = ws.stage(kept_terms(runs, shards, least), "terms")
    ws.drop("runs")
    languages = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    postings = terms.select("lang", "term", "total", F.inline("postings"))
    sums = postings.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = ws.stage(
        given.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang", "source", F.monotonically_increasing_id().alias("number"),
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n", "v", "n_lang")],
        )
        .withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0).cast("bigint"), F.col("n") + F.col("v"))).otherwise(1)),
        "groups",
    )
    shares = ws.stage(
        postings.join(groups, ["lang", "source"]).select(
            "lang", "term", "number", _share(F.col("count"), F.col("n") + F.col("v")).alias("p"), "p0",
            _share(F.col("total"), F.col("n_lang") + F.col("v")).alias("q"),
        ),
        "shares",
    )
    return ws.finish(_term_part(shares, groups, top).unionByName(_pair_part(ws, shares, groups)))


def _place(group: str) -> Column:
    return F.row_number().over(Window.partitionBy(group).orderBy(F.desc("value"), "item")).alias("rank")


def _term_part(shares: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    above = shares.where("p > q").select("number", F.col("term").alias("item"), _drift(F.col("p"), F.col("q")).alias("value"))
    # Each task keeps its own first ones before the rest is ranked, so a source of any size sends few rows.
    first = above.select("*", _place("number")).where(F.col("rank") <= top)
    return first.join(groups.select("number", "lang", "source"), "number").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )


def _pair_part(ws: Workspace, shares: DataFrame, groups: DataFrame) -> DataFrame:
    own = groups.select("lang", F.col("number").alias("a"), F.col("source"), F.col("p0").alias("pa"), "v")
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("p0").alias("pb"))
    pairs = own.join(other, "lang").where("a <> b")
    both = _co_posted(
        shares.groupBy("lang", "term").agg(F.collect_list(F.struct("number", "p", "p0")).alias("sharing")).where(F.size("sharing") > 1)
    )
    # How many terms have which share in a source: what they add depends on the other source alone.
    alike = shares.groupBy("lang", F.col("number").alias("a"), "p", F.col("p0").alias("pa")).agg(F.count(F.lit(1)).alias("times"))
    met = alike.join(other, "lang").where("a <> b")
    p, pa_, pb = F.col("p"), F.col("pa"), F.col("pb")
    alone = met.select(
        F.inline(
            F.array(
                F.struct("a", "b", (_wide(F.col("times")) * _wide(_drift(p, pb) - _drift(pa_, pb))).cast("decimal(38,0)").alias("value")),
                F.struct(
                    F.col("b").alias("a"), F.col("a").alias("b"),
                    (_wide(F.col("times")) * _wide(_drift(pb, p) - _drift(pb, pa_))).cast("decimal(38,0)").alias("value"),
                ),
            )
        )
    )
    more = ws.stage(
        both.where("a <> b").select("a", "b", _wide(F.col("value")).alias("value")).unionByName(alone)
        .groupBy("a", "b").agg(F.sum("value").cast("decimal(38,0)").alias("more")),
        "corrections",
    )
    base = _wide(F.col("v")) * _wide(_drift(F.col("pa"), F.col("pb")))
    value = (base + F.coalesce("more", F.lit(0).cast("decimal(38,0)"))).cast("bigint")
    valued = pairs.join(more, ["a", "b"], "left").select("lang", "source", "a", "item", value.alias("value"))
    return valued.select("lang", "source", F.lit("pair").alias("part"), "item", "value", _place("a"))
