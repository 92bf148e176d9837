"""Text quality by random-indexing word vectors and a small neural network.

Every word has a fixed sparse random index vector, read off its hash; a word's context vector is the sum of the index
vectors of the words around it, over all occurrences in the corpus. The ``HEAD`` most frequent
words have a context vector each; rarer words share ``2**TAIL_BITS`` of them by hash. Their number is fixed
while what they sum up grows with the corpus. Tokens are runs of letters, digits or signs; capitals and
repeated words each add a token of their own, so that they are counted as words are.
A document is the mean of its tokens' vectors and the mean of their squares; a
two-layer network in numpy reads that, and its probabilities are calibrated by a temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.labels import held_out, labelled_sample
from textloom.llm.tables import Workspace, map_texts, texts_of

#: Words with a context vector of their own, and the vectors that all others share.
HEAD, TAIL_BITS = 1 << 15, 14
WIDTH = 32
NONZERO = 2
REACH = 2
#: Tokens, and bytes of texts, that are looked at together.
BLOCK, BLOCK_BYTES = 1 << 16, 1 << 18
#: Learned from: at most so many documents a class.
PER_CLASS = 3000
HIDDEN, EPOCHS, BATCH, RATE = 32, 60, 128, 3e-3
FOLDS, FOLD = 4, 2

_KIND = np.full(256, 3, np.uint8)
_KIND[W.BLANKS] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_CAPITALS, _REPEAT, _LINE = (W.mix(np.array([n], W.U64))[0] for n in (101, 102, 103))


def token_blocks(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``hashes, owners, first, last`` for runs of texts of some ``BLOCK_BYTES`` together; a longer text stands alone.

    ``hashes`` are the texts' tokens in order, with the tokens for capitals, repeats and line ends behind theirs;
    ``owners`` are the places in ``texts[first:last]`` they come from.
    """
    first, raw, size = 0, [], 0
    for place, text in enumerate(texts):
        own = W.as_bytes(text)
        if raw and size + len(own) >= BLOCK_BYTES:
            yield *_tokens(raw), first, place
            first, raw, size = place, [], 0
        raw.append(own)
        size += len(own)
    if raw:
        yield *_tokens(raw), first, len(texts)


def tokens(text: str | None) -> np.ndarray:
    """Of one text."""
    return _tokens([W.as_bytes(text)])[0]


def _tokens(raw: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    blank = np.full(1, 32, np.uint8)  # between texts: it belongs to no token and ends no line
    data = np.concatenate([part for own in raw for part in (own, blank)])
    kind = _KIND[data]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(kind)]])
    word = kind[starts] != 0
    starts, stops = starts[word], stops[word]
    if len(starts) == 0:
        return np.empty(0, W.U64), np.empty(0, np.int64)
    owners = np.searchsorted(np.cumsum([len(own) + 1 for own in raw]), starts, "right")
    same = owners[1:] == owners[:-1]
    hashes = W.word_hashes(W.lowered(data), starts, stops)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123))])
    loud = (upper[stops] - upper[starts] >= 2) & (small[stops] == small[starts])
    again = np.concatenate([[False], same & (hashes[1:] == hashes[:-1])])
    line = np.flatnonzero(data == 10)
    passed = np.searchsorted(line, starts)  # no line end lies inside a token
    ends = np.concatenate([same & (passed[1:] > passed[:-1]), [False]])
    times = 1 + loud + again + ends
    place = np.cumsum(times) - times
    out = np.empty(int(times.sum()), W.U64)
    out[place] = hashes
    for mark, value in ((loud, _CAPITALS), (again, _REPEAT), (ends, _LINE)):
        place = place + mark
        out[place[mark]] = value
    return out, np.repeat(owners, times)


def frequent_words(docs: DataFrame, head: int = HEAD) -> np.ndarray:
    """Hashes of the ``head`` most frequent tokens of all texts, ascending; ties go to the smaller hash.

    Every token is counted: in slices first, in the tasks next, then by Spark. Only the ``head`` first come back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            names, n = np.unique(np.concatenate([np.empty(0, W.U64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

        for batch in batches:
            for hashes, *_ in token_blocks(batch.column("text").to_pylist()):
                held.append(hashes)
                if sum(map(len, held)) >= 1 << 19:
                    yield counted()
        yield counted()

    counts = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "word").limit(head).select("word").toArrow()
    return np.sort(found["word"].to_numpy().view(W.U64))


def rows_of(own: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """The row of each token's context vector: its own, or behind those the one that its hash picks."""
    shared = len(frequent) + (own >> W.U64(64 - bits)).astype(np.int64)
    if len(frequent) == 0:
        return shared
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    return np.where(frequent[at] == own, at, shared)


def index_entries(own: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``places, signs`` of the entries of each token's index vector; ``[..., NONZERO]``."""
    drawn = W.mix(own[..., None] + np.arange(1, NONZERO + 1).astype(W.U64) * W.U64(0x9E3779B97F4A7C15))
    return (drawn % W.U64(width)).astype(np.int64), np.where(drawn >> W.U64(63), 1, -1)


def context_sums(docs: DataFrame, frequent: np.ndarray, bits: int = TAIL_BITS, width: int = WIDTH, block: int = BLOCK) -> np.ndarray:
    """Context vectors over all texts: each task sums its own, Spark sums the tasks'. At most ``HEAD + 2**bits`` rows come back."""
    count = len(frequent) + (1 << bits)
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1) * width, np.int64)  # the last row takes what lies in two texts
        for batch in batches:
            for hashes, owners, _, _ in token_blocks(batch.column("text").to_pylist()):
                for start in range(0, len(hashes), block):
                    part, owner = hashes[start : start + block + REACH], owners[start : start + block + REACH]
                    centre = rows_of(part, sent.value, bits) * width
                    places, signs = index_entries(part, width)
                    for shift in range(1, REACH + 1):  # pairs whose first word is in the block
                        n = min(block, len(part) - shift)
                        if n <= 0:
                            continue
                        left, right = slice(0, n), slice(shift, shift + n)
                        same = owner[left] == owner[right]
                        for at, other in ((left, right), (right, left)):
                            row = np.where(same, centre[at], count * width)
                            for k in range(NONZERO):
                                np.add.at(total, row + places[other, k], np.ascontiguousarray(signs[other, k]))
        total = total[: count * width]
        rows = total.reshape(-1, width)
        used = np.flatnonzero(rows.any(axis=1))
        for start in range(0, len(used), 4096):
            part = used[start : start + 4096]
            yield pa.RecordBatch.from_pydict({"row": part, **{f"v{i}": rows[part, i] for i in range(width)}})

    names = [f"v{i}" for i in range(width)]
    partial = docs.select("text").mapInArrow(run, "row bigint, " + ", ".join(f"{n} bigint" for n in names))
    sums = partial.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((count, width))
    out[sums["row"].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], axis=1)
    return out


@dataclass(frozen=True)
class WordVectors:
    """Context vectors at length 1 by row. A word's own index vector is added: beforehand for frequent words, else where it is read."""

    frequent: np.ndarray
    vectors: np.ndarray
    bits: int

    @classmethod
    def of(cls, frequent: np.ndarray, sums: np.ndarray, bits: int) -> WordVectors:
        out = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        _add_index(out, np.arange(len(frequent)), frequent)
        return cls(frequent, out, bits)

    def pooled(self, texts: list) -> np.ndarray:
        """Mean and mean square of the vectors of each text's tokens; zeros without tokens. A text's row depends on it alone."""
        width = self.vectors.shape[1]
        out = np.zeros((len(texts), 2 * width))
        for hashes, owners, first, last in token_blocks(texts):
            # A block of several texts is taken at once, a long text in pieces.
            step = BLOCK if last == first + 1 else max(1, len(hashes))
            for start in range(0, len(hashes), step):
                part, owner = hashes[start : start + step], owners[start : start + step]
                rows = rows_of(part, self.frequent, self.bits)
                own = self.vectors[rows]
                rare = np.flatnonzero(rows >= len(self.frequent))
                _add_index(own, rare, part[rare])
                begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                out[first + owner[begin], :width] += np.add.reduceat(own, begin, axis=0, dtype=np.float64)
                out[first + owner[begin], width:] += np.add.reduceat(own**2, begin, axis=0, dtype=np.float64)
            out[first:last] /= np.maximum(np.bincount(owners, minlength=last - first), 1)[:, None]
        return out.astype(np.float32)


def _add_index(vectors: np.ndarray, rows: np.ndarray, own: np.ndarray) -> None:
    """The index vectors of the words ``own`` added to ``rows``, each of which stands once."""
    places, signs = index_entries(own, vectors.shape[1])
    for k in range(NONZERO):
        vectors[rows, places[:, k]] += (signs[:, k] / np.sqrt(NONZERO)).astype(np.float32)


def word_vectors(docs: DataFrame, head: int = HEAD, bits: int = TAIL_BITS) -> WordVectors:
    """Of all tokens of ``text``."""
    frequent = frequent_words(docs, head)
    return WordVectors.of(frequent, context_sums(docs, frequent, bits), bits)


@dataclass(frozen=True)
class Network:
    """Two layers on standardised features; ``shift`` moves the balanced sample's odds to the corpus'."""

    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0
    shift: float = 0.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.mean) / self.spread @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.logits(features) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(features: np.ndarray, labels: np.ndarray, prior: dict[int, int]) -> Network:
    """Adam on four fifths of the rows, temperature on the rest; ``prior`` are all learning rows' counts by class."""
    width = features.shape[1]
    odds = np.log((prior.get(1, 0) + 0.5) / (prior.get(0, 0) + 0.5))
    if len(set(labels.tolist())) < 2:
        zero = np.zeros((width, HIDDEN))
        return Network(np.zeros(width), np.ones(width), zero, np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0, float(odds))
    y = labels.astype(np.float64)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2:
        held = np.ones(len(y), bool)
    fit = ~held if not held.all() else held
    mean, spread = features[fit].mean(axis=0), features[fit].std(axis=0) + 1e-6
    x, target = (features - mean) / spread, y[fit]
    own = x[fit]
    balance = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    rng = np.random.Generator(np.random.PCG64(9))
    params = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, turn = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(own))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            w1, b1, w2, b2 = params
            hidden = np.tanh(own[rows] @ w1 + b1)
            delta = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - target[rows]) * balance[rows] / len(rows)
            back = np.outer(delta, w2) * (1 - hidden**2)
            grads = [own[rows].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ delta + 1e-4 * w2, np.array([delta.sum()])]
            turn += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - RATE * (m[i] / (1 - 0.9**turn)) / (np.sqrt(v[i] / (1 - 0.999**turn)) + 1e-8)
    network = Network(mean, spread, params[0], params[1], params[2], float(params[3][0]))
    z, t = network.logits(features[held]), y[held]
    share = prior.get(1, 1) / max(1, prior.get(1, 1) + prior.get(0, 1))
    weight = np.where(t == 1, share / max(1, (t == 1).sum()), (1 - share) / max(1, (t == 0).sum()))
    heat = np.geomspace(0.2, 10, 100)
    loss = [(weight * (np.logaddexp(0, z / h + odds) - t * (z / h + odds))).sum() for h in heat]
    return replace(network, temperature=float(heat[int(np.argmin(loss))]), shift=float(odds))


def fit_quality(
    source: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int
) -> tuple[WordVectors, Network]:
    """Word vectors of the whole corpus and a network fitted on a bounded sample of the labels outside the fold."""
    vectors = word_vectors(source)
    sample, prior = labelled_sample(source, labels, label, folds, fold, per_class)
    sent = source.sparkSession.sparkContext.broadcast(vectors)

    @F.arrow_udf("array<float>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array(list(sent.value.pooled(texts.to_pylist())), pa.list_(pa.float32()))

    rows = sample.select("doc_id", "label", features("text").alias("x")).toPandas()  # at most 2 * per_class short rows
    rows["order"] = [tuple(x) for x in rows["x"]]
    rows = rows.sort_values(["doc_id", "label", "order"])
    mixed = np.random.Generator(np.random.PCG64(5)).permutation(len(rows))
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), 2 * vectors.vectors.shape[1])[mixed]
    return vectors, train(x, rows["label"].to_numpy()[mixed], prior)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = FOLDS,
    fold: int = FOLD,
    threshold: float = 0.7,
    per_class: int = PER_CLASS,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The vectors sum up all of ``docs``; labels come from rows outside the fold, at most ``per_class`` of
    each class. Null and empty texts have no tokens and
    score what a zero vector scores. Without labels of both classes the score is the share of good rows. Null ids are
    scored and never held out; repeated rows score alike; an empty table gives no rows.
    """
    source = texts_of(docs, key, text)
    vectors, network = fit_quality(source, labels, label, folds, fold, per_class)
    sent = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(ids: list, texts: list) -> pa.RecordBatch:
        own, net = sent.value
        found = net.scores(own.pooled(texts).astype(np.float64))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found)], ["doc_id", "score"])

    ws = Workspace(docs.sparkSession, "quality")
    return ws.finish(
        map_texts(source, run, "doc_id bigint, score double").select(
            "doc_id",
            held_out(F.col("doc_id"), folds, fold).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )


def quality_filter(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = FOLDS, fold: int = FOLD, threshold: float = 0.7, per_class: int = PER_CLASS,
) -> Column:
    """A condition on ``docs`` that is true for the rows scoring ``threshold`` or more: rows are judged where they are."""
    vectors, network = fit_quality(texts_of(docs, key, text), labels, label, folds, fold, per_class)
    sent = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own, net = sent.value
        return pa.array(net.scores(own.pooled(texts.to_pylist()).astype(np.float64)), pa.float64())

    return score(F.coalesce(F.col(text).cast("string"), F.lit(""))) >= threshold
