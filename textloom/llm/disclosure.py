"""Personal data: fixed patterns, and terms that give a protected entity away.

The entities are what the patterns find. A term gives an entity away when seeing
the term makes the entity nearly certain: its pointwise mutual information with the entity, as a share of
the entity's own information, reaches ``DISCLOSURE``. Both come from counts over the whole corpus: in
how many different texts the entity occurs, the term occurs, and the term stands within ``REACH``
words of the entity. Copies of a text count once, so that repetition alone gives nothing away.
No count is too small to be judged: ``SMOOTHING`` more texts are thought to hold the term, and the entity as often
as any text does. One text is enough for the only one with its entity among a hundred or more; a frequent entity needs more.
Such terms are spans of kind ``term``; a sanitised text has all spans replaced by their kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.sieve import SIEVE_BITS, in_sieve, sieve_of
from textloom.llm.tables import Workspace, map_texts, texts_of

KINDS = ("email", "ip", "card", "phone", "term")
REACH = 8
#: Share of an entity's information that a term may reveal, and texts added to those that hold the term.
DISCLOSURE, SMOOTHING = 0.8, 1.5

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: a match holds one ``@``, begins where the run of local signs before it does, and takes all of the domain."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of what the patterns find, in order."""
    out = [(start, 0, end) for start, end in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entity(text: str, span: tuple[int, int, int]) -> int:
    """A signed 64-bit hash of the entity, however it is written."""
    start, kind, end = span
    own = text[start:end].lower() if kind == 0 else text[start:end] if kind == 1 else _digits(text[start:end])
    return W.digest(W.hashed_words(f"{kind}:{own}".encode("utf-8", "surrogatepass"), ends=np.zeros(256, bool)))


def _terms(text: str, data: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hash, start, end`` (code points) of the words that have a letter and lie in no span."""
    starts, stops = W.word_bounds(data, W.MARKS)
    hashes = W.word_hashes(data, starts, stops)
    letters = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123) | (data >= 128))])
    good = letters[stops] > letters[starts]
    hashes, starts, stops = hashes[good], starts[good], stops[good]
    if len(data) != len(text):
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts, stops = chars[starts], chars[stops]
    for first, _, last in spans:
        low, high = np.searchsorted(stops, first, "right"), np.searchsorted(starts, last, "left")
        if low < high:
            keep = np.r_[0:low, high : len(starts)]
            hashes, starts, stops = hashes[keep], starts[keep], stops[keep]
    return hashes, starts, stops


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
_PAIRS = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))
_PLACES = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, spans, entities, pairs``: ``pairs`` are the distinct terms around each distinct entity."""

    def run(ids: list, texts: list) -> pa.RecordBatch:
        digests, spans, entities, pairs = [], [], [], []
        for text in texts:
            data = W.as_bytes(text, lower=True)
            digests.append(_digest(data))
            found = base_spans(text)
            spans.append([{"start": a, "kind": k, "stop": b} for a, k, b in found])
            named = [_entity(text, s) for s in found]
            entities.append(sorted(set(named)))
            around: set[tuple[int, int]] = set()
            if found:
                hashes, starts, stops = _terms(text, data, found)
                signed = hashes.view(np.int64).tolist()
                for (first, _, last), entity in zip(found, named, strict=True):
                    low, high = int(np.searchsorted(stops, first, "right")), int(np.searchsorted(starts, last, "left"))
                    around.update((entity, t) for t in signed[max(0, low - REACH) : high + REACH])
            pairs.append([{"entity": e, "term": t} for e, t in sorted(around)])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(spans, _SPANS),
             pa.array(entities, pa.list_(pa.int64())), pa.array(pairs, _PAIRS)],
            ["doc_id", "digest", "spans", "entities", "pairs"],
        )

    return map_texts(
        docs, run,
        "doc_id bigint, digest bigint, spans array<struct<start:int,kind:int,stop:int>>, entities array<bigint>, "
        "pairs array<struct<entity:bigint,term:bigint>>",
    )


def _frequencies(docs: DataFrame, sieve, repeated, bits: int) -> DataFrame:
    """``term, alone, here``: of the terms that pass the sieve, in how many of a task's different texts each occurs.

    ``alone`` counts texts without copies only, so that its sum over all tasks is never more than there are different
    texts with the term; neither is the largest ``here``.
    """

    def summed(parts: list) -> tuple:
        terms, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return terms, *(np.bincount(place, np.concatenate([p[i] for p in parts]), len(terms)).astype(np.int64) for i in (1, 2))

    def rows(found: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), *map(pa.array, found[1:])], ["term", "alone", "here"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        parts, held = [], 0
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                data = W.as_bytes(text, lower=True)
                digest = _digest(data)
                if digest in known:
                    continue
                known.add(digest)
                hashes = _terms(text, data, base_spans(text))[0]
                terms = np.unique(hashes[in_sieve(sieve.value, hashes, bits)])
                copied = in_sieve(repeated.value, np.array([digest], np.int64).view(W.U64), bits)[0]
                parts.append((terms, np.full(len(terms), int(not copied)), np.ones(len(terms), np.int64)))
                held += len(terms)
                if held > 1 << 20:
                    parts = [summed(parts)]
                    held = len(parts[0][0])
                    if held > 1 << 19:
                        yield rows(parts[0])
                        parts, held = [], 0
        if held:
            yield rows(summed(parts))

    return docs.select("text").mapInArrow(run, "term bigint, alone bigint, here bigint")


def _places(docs: DataFrame, sieve, bits: int) -> DataFrame:
    """``doc_id, digest, places``: where terms that pass the sieve stand."""

    def run(ids: list, texts: list) -> pa.RecordBatch:
        digests, places = [], []
        for text in texts:
            data = W.as_bytes(text, lower=True)
            digests.append(_digest(data))
            hashes, starts, stops = _terms(text, data, [])
            passed = in_sieve(sieve.value, hashes, bits)
            if passed.any():
                hashes, starts, stops = _terms(text, data, base_spans(text))
                passed = in_sieve(sieve.value, hashes, bits)
            own = zip(hashes[passed].view(np.int64).tolist(), starts[passed].tolist(), stops[passed].tolist(), strict=True)
            places.append([{"term": t, "start": a, "stop": b} for t, a, b in own])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(places, _PLACES)], ["doc_id", "digest", "places"]
        )

    return map_texts(docs, run, "doc_id bigint, digest bigint, places array<struct<term:bigint,start:int,stop:int>>")


def sensitive_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, smoothing: float = SMOOTHING
) -> DataFrame:
    """One row per document: ``doc_id, digest, spans``; spans are ``(start, kind, stop)`` in code points, kinds as in ``KINDS``.

    Null is empty; a text without entities or disclosing terms has no spans. Entities and terms are
    compared without case. Null and repeated ids are ordinary rows: rows that agree in id and text have the same
    result. Ties at the thresholds count as disclosing. Counts are of different texts, over all documents.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "disclosure")
    source = texts_of(docs, key, text)
    scanned = ws.stage(_scan(source), "scanned")
    pairs = scanned.select("digest", F.explode("pairs").alias("p")).select("digest", "p.entity", "p.term").distinct()
    n_texts = float(max(scanned.select("digest").distinct().count(), 1))
    named = scanned.select("digest", F.explode("entities").alias("entity")).distinct()
    n_entity = named.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # The share of texts with the entity among those with the term is (n_both + smoothing * share) / (n_term + smoothing);
    # solved for n_term, that is how many texts a term may at most occur in and still disclose.
    share = F.col("n_entity") / F.lit(n_texts)
    most = (F.col("n_both") + smoothing * share) * F.pow(share, F.lit(disclosure - 1)) - smoothing + 1e-9
    terms = ws.stage(
        pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
        .join(n_entity, "entity").where(share < 1).withColumn("most", most).where(F.col("n_both") <= F.col("most"))
        .groupBy("term").agg(F.max("most").alias("most")),
        "terms",
    )
    sieve = spark.sparkContext.broadcast(sieve_of(terms.select(F.col("term").alias("gram")), SIEVE_BITS))
    copied = scanned.groupBy(F.col("digest").alias("gram")).count().where("count > 1")
    repeated = spark.sparkContext.broadcast(sieve_of(copied, SIEVE_BITS))
    least = _frequencies(source, sieve, repeated, SIEVE_BITS).groupBy("term").agg(
        F.greatest(F.sum("alone"), F.max("here")).alias("least")
    )
    # What surely occurs in too many texts is not looked up; of the rest every text is counted.
    rare = ws.stage(terms.join(least, "term").where(F.col("least") <= F.col("most")).select("term", "most"), "rare")
    sieve = spark.sparkContext.broadcast(sieve_of(rare.select(F.col("term").alias("gram")), SIEVE_BITS))
    places = ws.stage(_places(source, sieve, SIEVE_BITS), "places")
    seen = places.select("digest", F.explode("places").alias("p")).select("digest", "p.term").distinct()
    n_term = seen.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    disclosing = ws.stage(rare.join(n_term, "term").where(F.col("n_term") <= F.col("most")).select("term"), "disclosing")
    found = (
        places.select("doc_id", "digest", F.explode("places").alias("p"))
        .select("doc_id", "digest", "p.term", "p.start", "p.stop")
        .join(disclosing, "term", "left_semi")
        .groupBy(F.col("doc_id").alias("found_id"), F.col("digest").alias("found_digest"))
        .agg(F.collect_set(F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "stop")).alias("terms"))
    )
    same = [scanned["doc_id"].eqNullSafe(found["found_id"]), scanned["digest"] == found["found_digest"]]
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    joined = scanned.select("doc_id", "digest", "spans").join(found, same, "left")
    return ws.finish(
        joined.select("doc_id", "digest", F.array_sort(F.concat("spans", F.coalesce("terms", none))).alias("spans"))
    )


def sanitised(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in square brackets; spans inside others go with them.

    ``spans`` is what ``sensitive_spans`` found in the same documents. Rows meet their spans by id and text, so rows that
    repeat an id, or have none, keep their own; one row comes out for each that goes in. Null texts are empty.
    """
    found = spans.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "spans").dropDuplicates(["_id", "_digest"])

    def digests(ids: list, texts: list) -> pa.RecordBatch:
        own = [_digest(W.as_bytes(x, lower=True)) for x in texts]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(own, pa.int64())], ["doc_id", "text", "digest"])

    marked = map_texts(texts_of(docs, key, text), digests, "doc_id bigint, text string, digest bigint")
    merged = marked.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")

    @F.arrow_udf("string")
    def replaced(texts: pa.Array, rows: pa.Array) -> pa.Array:
        out = []
        for own, given in zip(texts.to_pylist(), rows.to_pylist(), strict=True):
            parts, done = [], 0
            for span in given or ():
                if span["start"] >= done:
                    parts += [own[done : span["start"]], f"[{KINDS[span['kind']].upper()}]"]
                done = max(done, span["stop"])
            out.append("".join(parts) + own[done:])
        return pa.array(out, pa.string())

    return merged.select("doc_id", replaced("text", "spans").alias("text"))


def _digest(lowered: np.ndarray) -> int:
    """Stands for a text, without case."""
    return W.digest(W.word_hashes(lowered, *W.word_bounds(lowered, np.zeros(256, bool))))


def span_count(spans, kind: int):
    """How many spans are of a kind, as a column."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def spans_text(spans, kinds: tuple[int, ...] | None = None):
    """``kind:start:end`` comma-joined, as a column."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
