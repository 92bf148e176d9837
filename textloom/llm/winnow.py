"""Benchmark decontamination by winnowing.

Both sides keep the minimum ``GRAM``-word hash of every run of ``WINDOW - GRAM + 1``
grams, so any shared span of ``WINDOW`` words shares a kept gram. Kept grams are joined
and each hit is extended over the words around it; an extension of ``WINDOW`` words or
more is an occurrence. An item of fewer words is one window of its own length: for these
few lengths every run of that many words is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.sieve import SIEVE_BITS, in_sieve, sieve_of
from textloom.llm.tables import Workspace, map_texts, texts_of

WINDOW = 10
GRAM = 5
_HITS = "array<struct<n:int,gram:bigint,pos:int,around:array<bigint>>>"


def _around(words: np.ndarray, places: np.ndarray, window: int, gram: int, outside: int) -> np.ndarray:
    """For each place the ``2 * window - gram`` words that can be in a window with its gram."""
    side = window - gram
    padded = np.full(len(words) + 2 * side, outside, W.U64)
    padded[side : side + len(words)] = words
    return padded[places[:, None] + np.arange(2 * window - gram)]


def _grams(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept places and their gram hashes."""
    hashes = W.gram_hashes(words, gram)
    places = W.lowest_in_windows(hashes, window - gram + 1)
    return places, hashes[places]


def item_fingerprints(items: DataFrame, item_key: str, text: str, window: int, gram: int) -> DataFrame:
    """``item_id, n, gram, around``: kept grams of long items, the one whole window of short ones."""
    schema = f"doc_id bigint, hits {_HITS}"

    def rows(ids: list, texts: list) -> pa.RecordBatch:
        out = []
        for text in texts:
            words = W.hashed_words(text, lower=True, ends=W.MARKS)
            if len(words) >= window:
                places, hashes = _grams(words, window, gram)
                out.append(_structs(window, places, hashes, _around(words, places, window, gram, 1)))
            elif len(words):
                out.append(_structs(len(words), np.zeros(1, int), W.gram_hashes(words, len(words)), words[None, :]))
            else:
                out.append([])
        return _batch({"doc_id": ids, "hits": out})

    found = map_texts(texts_of(items, item_key, text), rows, schema)
    return found.select(F.col("doc_id").alias("item_id"), F.explode("hits").alias("h")).select(
        "item_id", "h.n", "h.gram", "h.around"
    )


def _structs(n: int, places: np.ndarray, hashes: np.ndarray, around: np.ndarray) -> list[dict]:
    signed = zip(places.tolist(), hashes.view(np.int64).tolist(), around.view(np.int64).tolist(), strict=True)
    return [{"n": n, "gram": g, "pos": p, "around": a} for p, g, a in signed]


_TYPES = {
    "doc_id": pa.int64(),
    "digest": pa.int64(),
    "n_words": pa.int64(),
    "hits": pa.list_(
        pa.struct([("n", pa.int32()), ("gram", pa.int64()), ("pos", pa.int32()), ("around", pa.list_(pa.int64()))])
    ),
}


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns, schema=pa.schema([(name, _TYPES[name]) for name in columns]))


def document_hits(docs: DataFrame, sieve, lengths: list[int], window: int, gram: int, bits: int) -> DataFrame:
    """``doc_id, digest, n_words, hits``: kept grams, and runs as long as a short item, that pass the sieve."""
    schema = f"doc_id bigint, digest bigint, n_words bigint, hits {_HITS}"

    def rows(ids: list, texts: list) -> pa.RecordBatch:
        out: dict = {"doc_id": ids, "digest": [], "n_words": [], "hits": []}
        known = sieve.value
        for text in texts:
            words = W.hashed_words(text, lower=True, ends=W.MARKS)
            places, hashes = _grams(words, window, gram)
            passed = in_sieve(known, hashes, bits)
            places = places[passed]
            found = _structs(window, places, hashes[passed], _around(words, places, window, gram, 0))
            for n in lengths:
                hashes = W.gram_hashes(words, n)
                places = np.flatnonzero(in_sieve(known, hashes, bits))
                found += _structs(n, places, hashes[places], words[places[:, None] + np.arange(n)])
            out["digest"].append(W.digest(words))
            out["n_words"].append(len(words))
            out["hits"].append(found)
        return _batch(out)

    return map_texts(docs, rows, schema)


def _run(pairs: list[tuple[Column, Column]]) -> Column:
    """How many of the pairs agree before the first that does not."""
    out: Column = F.lit(len(pairs))
    for k, (a, b) in reversed(list(enumerate(pairs))):
        out = F.when(a != b, F.lit(k)).otherwise(out)
    return out


def _span(window: int, gram: int) -> Column:
    """The extension of a hit as ``struct(start, stop)``, null when it is shorter than a window."""
    side = window - gram
    both = [(F.col("around")[i], F.col("item_around")[i]) for i in range(2 * window - gram)]
    left, right = _run(both[:side][::-1]), _run(both[side + gram :])
    same = _run(both[side : side + gram]) == gram
    span = F.struct((F.col("pos") - left).alias("start"), (F.col("pos") + gram + right).alias("stop"))
    whole = F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("stop"))
    return F.when(F.col("n") == window, F.when(same & (left + right >= side), span)).when(
        F.col("around") == F.col("item_around"), whole
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    sieve_bits: int = SIEVE_BITS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, spans, contaminated``.

    ``spans`` are the hit word ranges ``(start, stop)``, ``items`` the items with an occurring
    window. Null and empty texts have no words and no hits, items without words occur nowhere.
    Null and repeated ids are ordinary rows: a row is matched to its own result by its id and its
    words, so rows that agree in both have the same result. Ties between equal grams all count.

    Only hits move, in rows of some 150 bytes: grams pass a fixed-size sieve of the
    benchmark's grams inside the scan first, and the join on the gram keeps what is exact.
    """
    ws = Workspace(docs.sparkSession, "winnow")
    prints = ws.stage(item_fingerprints(items, item_key, item_text, window, gram), "items")
    # At most window - 1 rows.
    lengths = sorted(r["n"] for r in prints.where(F.col("n") < window).select("n").distinct().collect())
    sieve = docs.sparkSession.sparkContext.broadcast(sieve_of(prints, sieve_bits))
    scanned = ws.stage(
        document_hits(texts_of(docs, key, text), sieve, lengths, window, gram, sieve_bits), "documents"
    )
    contexts = prints.select("n", "gram", F.col("around").alias("item_around")).distinct()
    hits = scanned.select("doc_id", "digest", F.explode("hits").alias("h")).select("doc_id", "digest", "h.*")
    spans = ws.stage(
        hits.join(contexts, ["n", "gram"])
        .withColumn("span", _span(window, gram))
        .where("span IS NOT NULL")
        .select("doc_id", "digest", "span", "n", "gram", "item_around"),
        "spans",
    )
    covered = (
        spans.groupBy("doc_id", "digest")
        .agg(F.array_sort(F.collect_set("span")).alias("spans"))
        .withColumn(
            "n_hit",
            F.aggregate(
                "spans",
                F.struct(F.lit(0).alias("seen"), F.lit(0).cast("bigint").alias("hit")),
                lambda done, s: F.struct(
                    F.greatest(done["seen"], s["stop"]).alias("seen"),
                    (done["hit"] + F.greatest(s["stop"] - F.greatest(s["start"], done["seen"]), F.lit(0))).alias("hit"),
                ),
            )["hit"],
        )
    )
    owners = prints.select("n", "gram", F.col("around").alias("item_around"), "item_id").distinct()
    found = (
        spans.select("doc_id", "digest", "n", "gram", "item_around").distinct()
        .join(owners, ["n", "gram", "item_around"])
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("item_id").alias("items"))
    )
    per_doc = covered.alias("c").join(
        found.alias("f"), F.col("c.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("c.digest") == F.col("f.digest")), "left"
    ).select(F.col("c.doc_id").alias("hit_id"), F.col("c.digest").alias("hit_digest"), "spans", "n_hit", "items")
    base = scanned.select("doc_id", "digest", "n_words")
    joined = base.join(
        per_doc, base["doc_id"].eqNullSafe(per_doc["hit_id"]) & (base["digest"] == per_doc["hit_digest"]), "left"
    )
    none = F.array().cast("array<bigint>")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items_ = F.coalesce("items", none)
    return ws.finish(
        joined.select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(items_).cast("bigint").alias("n_items"),
            items_.alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
            (n_hit > 0).alias("contaminated"),
        )
    )
