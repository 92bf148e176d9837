"""Near-duplicate documents by min-max hashing.

Each permutation of a document's shingle hashes gives two signature values, its minimum
and its maximum, so ``PERMUTATIONS`` evaluations give twice as many values. ``ROWS``
values make a band; documents that agree in a band are candidates. Candidates are
compared on their full shingle sets, and the confirmed links give the components.

No pairs within a bucket are listed. A round compares the members of each bucket with a
few of them, its centres, and drops the centres and every bucket whose members have met
in one component. Rounds go on, with ``GROWTH`` times the centres, until no bucket is left. So a group of
thousands of near copies costs about one comparison a member, and no pair that may be linked and is not yet
known to be together goes uncompared. From the second round on, a member carries the parity of its shingles in
each of ``CELLS`` cells: two sets differ in at least as many shingles as parities, so most pairs that are
not similar enough are known inside the join, without reading a set. The rest meet on full sets.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.components import component_roots
from textloom.llm.sieve import in_sieve, sieve_of
from textloom.llm.tables import Workspace, map_texts, texts_of

SHINGLE = 5
#: A link: ``PERCENT * union <= 100 * intersection``.
PERCENT = 80
PERMUTATIONS = 70
#: Of 140 values in 28 bands, sets of similarity 0.85 share no band once in 10 million times; 0.8: once in 70 thousand.
ROWS = 5
#: Centres of a bucket in a round, as a multiple of those in the round before.
GROWTH = 64
#: Cells whose parities stand for a set in the bound on what two sets share; 64 a column, so that the
#: bound is a short compiled expression.
CELLS = 1024
_MARKS = [f"mark_{i}" for i in range(CELLS // 64)]
_CHUNK = 1 << 17
#: 32 MB: the largest bitmap of ids that is sent.
MOST_SIEVE_BITS = 28


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.Generator(np.random.PCG64(77)).integers(0, 2**64, (2, n), dtype=W.U64)
    return made[0] | W.U64(1), made[1]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    words = W.hashed_words(text, lower=True)
    return np.unique(W.gram_hashes(words, min(size, len(words)))) if len(words) else words


def signature(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """Minima and maxima under each permutation, alternating."""
    a, b = _constants(permutations)
    low, high = np.full(permutations, 2**64 - 1, W.U64), np.zeros(permutations, W.U64)
    step = max(1, _CHUNK // permutations)
    for start in range(0, len(shingles), step):
        values = a[:, None] * shingles[None, start : start + step] + b[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` values; the band's number is part of it."""
    kept = values[: len(values) // rows * rows].reshape(-1, rows)
    out = W.mix(np.arange(1, len(kept) + 1, dtype=W.U64))
    for i in range(rows):
        out = W.mix(out ^ kept[:, i])
    return out


def _set_key(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for the set."""
    first = W.mix(shingles ^ W.U64(0x1234567)).sum(dtype=W.U64)
    second = W.mix(shingles ^ W.U64(0xFEDCBA9876)).sum(dtype=W.U64)
    return first.tobytes() + second.tobytes()


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether each cell of hashes holds an odd number of the shingles, as ``CELLS / 64`` numbers."""
    cells = np.bincount((shingles >> W.U64(64 - CELLS.bit_length() + 1)).astype(np.int64), minlength=CELLS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, size: int, permutations: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands``; key and bands are null without words."""

    def run(ids: list, texts: list) -> pa.RecordBatch:
        n, keys, kept = [], [], []
        for text in texts:
            shingles = shingle_set(text, size)
            n.append(len(shingles))
            keys.append(_set_key(shingles) if len(shingles) else None)
            kept.append(bands(signature(shingles, permutations), rows).view(np.int64) if len(shingles) else None)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(kept, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_key", "bands"],
        )

    return map_texts(docs, run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` and the columns of ``parities``, of the wanted classes, from one document of each.

    A bitmap of the wanted ids goes to the texts, so sets are made where these lie and only sets move. It is sized by the
    number of ids; what passes it by chance finds no partner in the join.
    """
    firsts = wanted.select(F.col("first_id"), F.col("set_key").alias("class_key"), "node")
    number = firsts.count()
    bits = min(max(24, (8 * number).bit_length()), MOST_SIEVE_BITS)
    hashed = lambda ids: W.mix(np.array([-1 if i is None else i for i in ids], np.int64).view(W.U64))
    grams = firsts.select(F.coalesce("first_id", F.lit(-1)).alias("id")).distinct().mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_arrays([pa.array(hashed(b.column("id").to_pylist()).view(np.int64))], ["gram"]) for b in batches
        ),
        "gram bigint",
    )
    sieve = docs.sparkSession.sparkContext.broadcast(sieve_of(grams, bits))

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            passed = np.flatnonzero(in_sieve(sieve.value, hashed(ids), bits)) if ids else []
            for begin in range(0, len(passed), 2048):
                own = batch.take(pa.array(passed[begin : begin + 2048]))
                yield made(own.column("doc_id").to_pylist(), own.column("text").to_pylist())

    def made(ids: list, texts: list) -> pa.RecordBatch:
        keys, kept, marks = [], [], []
        for text in texts:
            shingles = shingle_set(text, size)
            keys.append(_set_key(shingles) if len(shingles) else None)
            kept.append(shingles.view(np.int64))
            marks.append(parities(shingles))
        columns = np.array(marks, np.int64).reshape(-1, len(_MARKS)).T
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(kept, pa.list_(pa.int64())), *map(pa.array, columns)],
            ["doc_id", "set_key", "shingles", *_MARKS],
        )

    numbers = ", ".join(f"{mark} bigint" for mark in _MARKS)
    sets = docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, set_key binary, shingles array<bigint>, {numbers}")
    same = [F.col("set_key") == F.col("class_key"), F.col("doc_id").eqNullSafe(F.col("first_id"))]
    # Rows that repeat an id and a text give the same set again: one is enough.
    return sets.join(firsts, same).dropDuplicates(["node"]).select("node", "shingles", *_MARKS)


def _linked(percent: int, shared: Column, a: Column, b: Column) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(first, "a").join(second, "b")
        .where(_linked(percent, shared, F.size("set_a"), F.size("set_b")))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Null and empty texts have no shingles and are linked with nothing: their component is
    their own id. Documents with equal shingle sets are one class and are compared once.
    A null id takes part in links but is never a component's id while another is there; alone, its
    component is null, and the row is kept. Rows that repeat an id keep a row each; the
    id counts as one document, so what either row links to is one component.
    """
    ws = Workspace(docs.sparkSession, "minmax")
    source = texts_of(docs, key, text)
    rows_ = ws.stage(sketches(source, shingle, permutations, rows), "sketches")
    classes = ws.stage(
        rows_.where("set_key IS NOT NULL").groupBy("set_key", "n_shingles")
        .agg(F.min("doc_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    same = [rows_["set_key"] == classes["set_key"], rows_["doc_id"].eqNullSafe(classes["first_id"])]
    banded = (
        rows_.join(classes, same)
        .select("node", rows_["n_shingles"], F.explode("bands").alias("band"))
        .distinct()
    )
    banded = ws.stage(banded, "bands")
    shared = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    buckets = ws.stage(banded.join(shared.select("band"), "band"), "buckets-0")
    ws.drop("bands")
    wanted = classes.join(buckets.select("node").distinct(), "node", "left_semi")
    sets = ws.stage(_sets_of(source, wanted, shingle), "sets")
    return ws.finish(_labelled(ws, rows_, classes, _all_roots(ws, buckets, sets, percent)))


def _all_roots(ws: Workspace, buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of what confirmed links connect, round by round (see the module's text)."""
    roots, centres, turn = None, 1, 0
    # Nothing is known yet: every node is its own component.
    buckets = buckets.withColumn("root", F.col("node"))
    while True:
        tried = ws.stage(_pairs_with_centres(buckets, centres, percent), f"tried-{turn}")
        found = ws.stage(_confirmed(tried, sets, percent), f"links-{turn}")
        if roots is None or not found.isEmpty():
            roots = ws.stage(component_roots(found, ws, f"roots-{turn}", roots), f"roots-of-{turn}")
        rest = _unsettled(buckets, roots, centres)
        if turn == 0:
            rest = rest.join(sets.drop("shingles"), "node")
        turn += 1
        buckets = ws.stage(rest, f"buckets-{turn}")
        ws.drop(*[f"{name}-{turn - 1}" for name in ("tried", "links", "buckets")])
        if buckets.isEmpty():
            return roots
        centres *= GROWTH


def _with_centres(buckets: DataFrame, centres: int) -> DataFrame:
    """``band, centre`` and its columns: the ``centres`` first members of each bucket."""
    given = [c for c in buckets.columns if c not in ("band", "node")]
    if centres == 1:
        # Minima are combined in the tasks: the first round sees every bucket.
        low = buckets.groupBy("band").agg(F.min(F.struct("node", *given)).alias("low"))
        chosen = low.select("band", "low.*")
    else:
        place = F.row_number().over(Window.partitionBy("band").orderBy("node"))
        chosen = buckets.withColumn("place", place).where(F.col("place") <= centres)
    return chosen.select("band", F.col("node").alias("centre"), *[F.col(c).alias(f"{c}_centre") for c in given])


def _pairs_with_centres(buckets: DataFrame, centres: int, percent: int) -> DataFrame:
    """Distinct ``a, b`` of a centre and a member that may be linked and are not yet in one component."""
    pairs = buckets.join(_with_centres(buckets, centres), "band").where("node <> centre AND root <> root_centre")
    first, second = F.col("n_shingles"), F.col("n_shingles_centre")
    pairs = pairs.where(_linked(percent, F.least(first, second), first, second))
    if _MARKS[0] in buckets.columns:
        # Sets that differ in d shingles share (both sizes - d) / 2 of them.
        differ = reduce(add, [F.bit_count(F.col(mark).bitwiseXOR(F.col(f"{mark}_centre"))) for mark in _MARKS])
        pairs = pairs.where((100 + percent) * differ <= (100 - percent) * (first + second))
    return pairs.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()


def _unsettled(buckets: DataFrame, roots: DataFrame, centres: int) -> DataFrame:
    """Buckets without this round's centres, as far as their members are in several components."""
    done = _with_centres(buckets, centres).select("band", F.col("centre").alias("node"))
    left = buckets.drop("root").join(done, ["band", "node"], "left_anti")
    labelled = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    bounds = labelled.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return labelled.join(bounds.select("band"), "band")


def _labelled(ws: Workspace, rows: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """Each document with its component's smallest id."""
    # Classes that hold rows of one id belong together (only where ids repeat).
    named = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "set_key")
    owners = named.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high")
    nodes = classes.select("set_key", "node")
    repeated = (
        named.join(owners, "doc_id").join(nodes, "set_key")
        .join(nodes.select(F.col("set_key").alias("low"), F.col("node").alias("root")), "low")
        .select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    repeated = ws.stage(repeated, "repeated")
    roots = known if repeated.isEmpty() else component_roots(repeated, ws, "final", known)
    joined = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = joined.join(least, "root").select(F.col("set_key").alias("class_key"), "component_id")
    out = rows.join(of_class, rows["set_key"] == of_class["class_key"], "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
