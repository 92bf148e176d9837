"""Repeated word windows, found by compressed full-text indexes of bounded shards.

A window of ``WINDOW`` words holds at least one anchor: a place whose ``GRAM``-word hash is
the lowest of its run. Equal windows have equal anchors, so

1. anchors that stand in one document only are dropped, by counts combined in the tasks;
2. around every other anchor the words that can be in a window with it are a segment.
   Segments are routed by their anchor, so all equal windows meet in one shard;
3. each shard indexes its distinct segments (an FM-index over a wavelet matrix), streams
   them through backward search, and reports for every place where the matching
   statistics reach ``WINDOW`` the smallest document that has the window;
4. a document's windows that a smaller document has are cut from its text.

An anchor of more than ``HOT`` documents would draw their different surroundings into one
shard: its windows are routed one by one, by their own hash, and equal ones are combined first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.fm_index import GAP, FMIndex
from textloom.llm.tables import Workspace, map_texts, texts_of

WINDOW = 13
GRAM = 4
#: Documents from which on an anchor's windows are routed one by one.
HOT = 50_000
#: Segments that a shard is to hold: some 20 words each, some 200 MB while it is indexed.
SHARD = 60_000
_LAST = (1 << 63) - 1
#: Anchors are compared by 48 bits: a clash only lets a segment through that repeats nowhere.
_ANCHOR = W.U64((1 << 48) - 1)


def _anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors."""
    hashes = W.gram_hashes(words, gram)
    places = W.lowest_in_windows(hashes, window - gram + 1)
    return places, (hashes[places] & _ANCHOR).view(np.int64)


def _segments(places: np.ndarray, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the words that share a window with each anchor."""
    return np.maximum(places - (window - gram), 0), np.minimum(places + window, n)


def _windows(places: np.ndarray, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every window that holds one of the anchors."""
    starts = (places[:, None] + np.arange(gram - window, 1)).ravel()
    starts = np.unique(starts[(starts >= 0) & (starts <= n - window)])
    return starts, starts + window


def _document_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, anchors``: each document's distinct anchors; null ids count as the largest."""

    def run(ids: list, texts: list) -> pa.RecordBatch:
        found = [np.unique(_anchors(W.hashed_words(text), window, gram)[1]) for text in texts]
        return pa.RecordBatch.from_arrays(
            [pa.array([_LAST if i is None else i for i in ids], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
            ["doc_id", "anchors"],
        )

    return map_texts(docs, run, "doc_id bigint, anchors array<bigint>")


def _shared_anchors(ws: Workspace, docs: DataFrame, window: int, gram: int, hot: int) -> DataFrame:
    """``owner, plain, hot``: each document's anchors that another document has too."""
    rows = ws.stage(_document_anchors(docs, window, gram), "anchors").select("doc_id", F.explode("anchors").alias("anchor"))
    several = (
        rows.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("anchor", (F.col("n") > hot).alias("hot"))
    )
    several = ws.stage(several, "several")
    own = rows.join(several, "anchor")
    lists = own.groupBy(F.col("doc_id").alias("owner")).agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("plain"),
        F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"),
    )
    out = ws.stage(lists, "shared")
    ws.drop("anchors", "several")
    return out


def _cut_segments(docs: DataFrame, shared: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, segment, route, words, documents``: a row per document and distinct segment.

    ``words`` (the segment's bytes) stands once per slice of documents, in its smallest document's row, with the
    number of the slice's documents that have the segment.
    """
    types = pa.schema(
        [("doc_id", pa.int64()), ("segment", pa.int64()), ("route", pa.int64()), ("words", pa.binary()), ("documents", pa.int64())]
    )

    def one(doc_id: int, text: str, plain: np.ndarray, hot: np.ndarray):
        data = W.as_bytes(text)
        starts, stops = W.word_bounds(data)
        words = W.word_hashes(data, starts, stops)
        places, anchors = _anchors(words, window, gram)
        own = np.isin(anchors, plain)
        crowded = np.isin(anchors, hot) if len(hot) else np.zeros(len(anchors), bool)
        first, end = _segments(places[own], len(words), window, gram)
        alone, alone_end = _windows(places[crowded], len(words), window, gram)
        first, end = np.concatenate([first, alone]).astype(np.int64), np.concatenate([end, alone_end]).astype(np.int64)
        segments = W.run_digests(words, first, end).view(np.int64) if len(first) else np.empty(0, np.int64)
        routes = np.concatenate([anchors[own], segments[own.sum() :]])
        segments, chosen = np.unique(segments, return_index=True)
        return segments, routes[chosen], data, starts[first[chosen]], stops[end[chosen] - 1] if len(chosen) else chosen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                columns = [part.column(c).to_pylist() for c in ("doc_id", "text")]
                lists = [part.column(c) for c in ("plain", "hot")]
                cut = [
                    one(doc_id, text, plain.values.to_numpy(), hot.values.to_numpy())
                    for doc_id, text, plain, hot in zip(*columns, *lists, strict=True)
                ]
                ids = np.repeat([_LAST if i is None else i for i in columns[0]], [len(c[0]) for c in cut]).astype(np.int64)
                if len(ids) == 0:
                    continue
                segments, routes = np.concatenate([c[0] for c in cut]), np.concatenate([c[1] for c in cut])
                raw = [c[2][a:b].tobytes() for c in cut for a, b in zip(c[3].tolist(), c[4].tolist(), strict=True)]
                order = np.lexsort((ids, segments))
                first = np.concatenate([[True], segments[order][1:] != segments[order][:-1]])
                n = np.diff(np.append(np.flatnonzero(first), len(order)))
                documents = np.zeros(len(order), np.int64)
                documents[order[first]] = n
                words = [own if count else None for own, count in zip(raw, documents.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(segments), pa.array(routes), pa.array(words, pa.binary()), pa.array(documents)],
                    schema=types,
                )

    key = F.coalesce("doc_id", F.lit(_LAST))
    joined = docs.withColumn("_key", key).join(shared, F.col("_key") == F.col("owner")).select("doc_id", "text", "plain", "hot")
    return joined.mapInArrow(run, "doc_id bigint, segment bigint, route bigint, words binary, documents bigint")


def window_owners(segments: list[bytes], owners: np.ndarray, window: int) -> list[np.ndarray]:
    """For each segment and each of its windows the smallest owner of a segment that holds the window."""
    joined = np.frombuffer(b"\n".join([*segments, b""]), np.uint8)
    starts, stops = W.word_bounds(joined)
    numbers = np.unique(W.word_hashes(joined, starts, stops), return_inverse=True)[1].astype(np.int64) + 1
    edges = np.concatenate([[0], np.cumsum([len(s) + 1 for s in segments])])
    sizes = np.diff(np.searchsorted(starts, edges))
    rows = np.repeat(np.arange(len(segments)), sizes)
    inside = np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    patterns = np.full((len(segments), int(sizes.max(initial=0))), GAP, np.int64)
    patterns[rows, inside] = numbers
    text = np.full(len(numbers) + len(segments), GAP, np.int64)
    text[np.arange(len(numbers)) + rows] = numbers
    owner = np.repeat(owners, sizes + 1)
    index = FMIndex(text, window)
    heads = np.flatnonzero(np.concatenate([[True], index.group[1:] != index.group[:-1]]))
    least = np.minimum.reduceat(owner[index.suffixes], heads)
    length, low = index.matching_statistics(patterns, sizes)
    found = np.where(length == window, least[index.group[low]], _LAST)
    return [found[i, : max(0, size - window + 1)] for i, size in enumerate(sizes.tolist())]


def _shard_results(routed: DataFrame, window: int) -> DataFrame:
    """``segment, owners`` of the routed segments that another document shares in part or as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[int, int] = {}
        words: list[bytes] = []
        owners: list[int] = []
        documents: list[int] = []
        for batch in batches:
            for segment, own, owner, n in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                at = place.setdefault(segment, len(words))
                if at == len(words):
                    words.append(own)
                    owners.append(owner)
                    documents.append(n)
                else:
                    owners[at] = min(owners[at], owner)
                    documents[at] += n
        if not words:
            return
        least = np.array(owners, np.int64)
        found = window_owners(words, least, window)
        names = list(place)
        keep = [i for i, own in enumerate(found) if documents[i] > 1 or (own < least[i]).any()]
        for start in range(0, len(keep), 10_000):
            part = keep[start : start + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in part], pa.int64()), pa.array([found[i] for i in part], pa.list_(pa.int64()))],
                ["segment", "owners"],
            )

    columns = ("segment", "words", "doc_id", "documents")
    return routed.select(*columns).mapInArrow(run, "segment bigint, owners array<bigint>")


def _joined(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> bytes:
    """The words with one blank between them."""
    if len(starts) == 0:
        return b""
    out = data.copy()
    out[stops[:-1]] = 0x20  # the byte behind a word that is not the last is a blank of some kind
    edges = np.zeros(len(data) + 2, np.int8)
    edges[starts] = 1
    edges[np.append(stops[:-1] + 1, stops[-1])] -= 1
    return out[np.cumsum(edges[: len(data)], dtype=np.int8).astype(bool)].tobytes()


def _cut_texts(docs: DataFrame, cuts: DataFrame, window: int, gram: int, single: bool, with_text: bool) -> DataFrame:
    """The result rows: windows that the cuts name are cut from each text."""

    def one(text: str, segments: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> tuple[int, int, bytes]:
        data = W.as_bytes(text)
        starts, stops = W.word_bounds(data)
        n = len(starts)
        kept = np.arange(n)
        if len(segments):
            words = W.word_hashes(data, starts, stops)
            first, end = _segments(_anchors(words, window, gram)[0], n, window, gram)
            if single:
                alone = np.arange(max(0, n - window + 1))
                first, end = np.concatenate([first, alone]), np.concatenate([end, alone + window])
            own = W.run_digests(words, first, end).view(np.int64)
            order = np.argsort(segments)
            at = order[np.minimum(np.searchsorted(segments[order], own), len(segments) - 1)]
            hit = segments[at] == own
            at, first = at[hit], first[hit]
            # Every hit's windows: its first word plus each offset that its segment names.
            sizes = counts[at]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            gone = np.repeat(first, sizes) + begins[np.repeat((np.cumsum(counts) - counts)[at], sizes) + inside]
            edges = np.bincount(gone, minlength=n + window + 1) - np.bincount(gone + window, minlength=n + window + 1)
            kept = np.flatnonzero(np.cumsum(edges)[:n] == 0)
        return n, n - len(kept), _joined(data, starts[kept], stops[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                ids, texts = part.column("doc_id"), part.column("text").to_pylist()
                rows = []
                for text, segments, offsets in zip(texts, part.column("segments"), part.column("offsets"), strict=True):
                    if segments.is_valid:
                        flat, counts = offsets.values.flatten(), offsets.values.value_lengths()
                        rows.append(one(text, segments.values.to_numpy(), flat.to_numpy(), counts.to_numpy().astype(np.int64)))
                    else:
                        rows.append(one(text, none, none, none))
                out = [
                    ids,
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                ]
                if with_text:
                    out.append(pa.array([r[2].decode("utf-8", "surrogatepass") for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    none = np.empty(0, np.int64)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
    joined = docs.withColumn("_key", F.coalesce("doc_id", F.lit(_LAST))).join(cuts, F.col("_key") == F.col("owner"), "left")
    return joined.select("doc_id", "text", "segments", "offsets").mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    hot: int = HOT,
    shard: int = SHARD,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` and, if wanted, ``kept_text``.

    A word goes when a window of ``window`` words around it also starts in a document with a smaller id;
    the first document keeps all. Windows are judged on the input. Null and empty texts have no words;
    texts shorter than a window lose nothing. A null id counts as larger than every other, and rows that
    share an id, null or not, are one document: neither takes words from the other. Repeated rows have equal results.
    """
    ws = Workspace(docs.sparkSession, "substrings")
    source = texts_of(docs, key, text)
    shared = _shared_anchors(ws, source, window, gram, hot)
    single = not shared.where(F.size("hot") > 0).isEmpty()
    rows = ws.stage(_cut_segments(source, shared, window, gram), "segments")
    ws.drop("shared")
    routed = rows.where("words IS NOT NULL")
    shards = max(1, -(-routed.count() // shard))
    results = ws.stage(_shard_results(routed.repartition(shards, "route"), window), "results")
    begins = F.filter(F.sequence(F.lit(0), F.size("owners") - 1), lambda i: F.col("owners")[i] < F.col("doc_id"))
    cuts = (
        rows.select("doc_id", "segment").join(results, "segment")
        .select("doc_id", "segment", begins.alias("begins"))
        .where(F.size("begins") > 0)
        .groupBy(F.col("doc_id").alias("owner"))
        .agg(F.collect_set(F.struct("segment", "begins")).alias("cuts"))
        .select("owner", F.col("cuts.segment").alias("segments"), F.col("cuts.begins").alias("offsets"))
    )
    cuts = ws.stage(cuts, "cuts")
    return ws.finish(_cut_texts(source, cuts, window, gram, single, with_text))
