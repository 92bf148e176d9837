"""Toxicity by subword bags: character n-gram vectors averaged into a linear softmax.

A passage of ``PASSAGE`` words is the bag of the 3- to 5-character n-grams of its words, ends
marked; a word that was never seen shares most of its n-grams with the words it is a
variant of. Vectors and softmax are trained together in numpy. A document is as toxic as its worst
passage, so one insult in a long text counts as much as in a short one: learning first
gives every passage its document's label, then keeps a toxic document's worst passages only.

A linear layer over a mean of vectors is a mean of one number per n-gram, so a
trained model is a table of ``2**SLOT_BITS`` numbers, sent to every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import words as W
from textloom.llm.labels import held_out, labelled_sample
from textloom.llm.tables import Workspace, map_texts, texts_of

SIZES = (3, 4, 5)
SLOT_BITS = 17
WIDTH = 8
PASSAGE = 3
#: Bound of what is learned from: documents a class, each of them whole.
PER_CLASS = 1500
#: Passages whose means are taken at once.
BLOCK_PASSAGES = 1 << 16
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 4096, 0.3
FOLDS, FOLD = 5, 0


def subwords(text: str | bytes | None, bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """``slot, passage`` of every n-gram of the text's words (A-Z lowered; ASCII signs only end words)."""
    data = W.as_bytes(text, lower=True)
    apart = W.MARKS[data]
    symbols = np.zeros(len(data) + 2, np.uint8)
    symbols[1:-1] = np.where(apart, 0, data)
    ends = np.cumsum(np.concatenate([[0, 1], apart, [1]]))  # marks before each symbol
    begins = (symbols[1:] != 0) & (symbols[:-1] == 0)
    passage = np.cumsum(np.concatenate([begins, [False]])) - 1  # of the word that starts behind the symbol
    slots, owners = [], []
    for n in SIZES:
        count = len(symbols) - n + 1
        if count <= 0:
            continue
        # Nothing between the first and the last symbol is a mark.
        whole = np.flatnonzero(ends[n - 1 : n - 1 + count] == ends[2 : 2 + count])
        code = np.full(len(whole), W.U64(n))
        for i in range(n):
            code = code * W.U64(257) + symbols[whole + i]
        slots.append((W.mix(code) >> W.U64(64 - bits)).astype(np.int32))
        owners.append(np.maximum(passage[whole], 0) // PASSAGE)
    if not slots:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(slots), np.concatenate(owners)


def passage_means(slots: np.ndarray, owners: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean of the table over each passage's n-grams; one passage of value 0 for a text without words."""
    if len(slots) == 0:
        return np.zeros(1)
    n = np.bincount(owners)
    return np.bincount(owners, table[slots])[n > 0] / n[n > 0]


@dataclass(frozen=True)
class Model:
    """A number per n-gram slot, the bias, and the line that turns a worst passage into log odds."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        worst = passage_means(*subwords(text, int(len(self.table)).bit_length() - 1), self.table).max() + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30))))


class _Bags:
    """Passages of the sample: n-grams one after another, and where each passage begins."""

    def __init__(self, texts: list[str], bits: int):
        slots, sizes, owner = [], [], []
        for i, text in enumerate(texts):
            own, passage = subwords(text, bits)
            order = np.argsort(passage, kind="stable")
            n = np.bincount(passage) if len(own) else np.zeros(0, int)
            slots.append(own[order])
            sizes.append(n[n > 0])
            owner.append(np.full(len(sizes[-1]), i))
        self.slots = np.concatenate(slots) if slots else np.empty(0, np.int32)
        self.sizes = np.concatenate(sizes) if sizes else np.empty(0, int)
        self.owner = np.concatenate(owner) if owner else np.empty(0, int)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def batch(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[chosen]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.slots[np.repeat(self.starts[chosen], sizes) + inside], np.repeat(np.arange(len(chosen)), sizes)

    def means(self, table: np.ndarray) -> np.ndarray:
        if len(self.sizes) == 0:
            return np.zeros(0)
        sums = []
        for first in range(0, len(self.sizes), BLOCK_PASSAGES):
            starts = self.starts[first : first + BLOCK_PASSAGES + 1]
            sums.append(np.add.reduceat(table[self.slots[starts[0] : starts[-1]]], starts[:-1] - starts[0]))
        return np.concatenate(sums) / self.sizes


def fit_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of one variable, slightly held back: Newton steps that never lose."""
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    design = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    ridge = np.array([1e-3, 0.0])

    def loss(c: np.ndarray) -> float:
        z = design @ c
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + (ridge * c * c).sum() / 2)

    c = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ c, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + ridge * c
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-9)
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(c - size * step) > loss(c):
            size /= 2
        if size <= 1e-6 or float(np.abs(size * step).max()) < 1e-9:
            break
        c = c - size * step
    return float(c[0] / spread), float(c[1] - c[0] * mean / spread)


def train(texts: list[str], labels: list[int], prior: dict[int, int], bits: int = SLOT_BITS, width: int = WIDTH) -> Model:
    """Fit on the sample; every fifth text only calibrates. ``prior`` are all learning rows' counts by class."""
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:  # nothing to tell apart
        share = (prior.get(1, 0) + 0.5) / (sum(prior.values()) + 1)
        return Model(np.zeros(1 << bits), 0.0, 0.0, float(np.log(share / (1 - share))))
    rng = np.random.Generator(np.random.PCG64(11))
    bags = _Bags(texts, bits)
    calibrates = np.arange(len(y)) % 5 == 4
    vectors = rng.normal(0, 0.1, (1 << bits, width))
    weights, bias = rng.normal(0, 0.5, width), 0.0
    squares = np.full(1 << bits, 1e-8)
    squares_w, squares_b = np.full(width, 1e-8), 1e-8
    target = y[bags.owner]
    usable = np.flatnonzero(~calibrates[bags.owner])
    for turn in range(ROUNDS):
        chosen = usable
        if turn:
            means = bags.means(vectors @ weights)
            keep = np.zeros(len(target), bool)
            order = np.lexsort((-means, bags.owner))
            rank = np.arange(len(order)) - np.searchsorted(bags.owner[order], bags.owner[order])
            # A toxic text's worst passage, and others as far as they already look toxic.
            keep[order] = (rank == 0) | (means[order] + bias > 0)
            chosen = usable[(target[usable] == 0) | keep[usable]]
        positive = target[chosen] == 1
        balance = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())) * len(chosen)
        for _ in range(EPOCHS):
            order = rng.permutation(len(chosen))
            for start in range(0, len(order), BATCH):
                own = order[start : start + BATCH]
                slots, row = bags.batch(chosen[own])
                numbers = vectors @ weights
                n = bags.sizes[chosen[own]]
                z = np.bincount(row, numbers[slots], len(own)) / n + bias
                delta = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[chosen[own]]) * balance[own] / len(own)
                # The gradient of a slot's vector is its number's gradient times the weights.
                g = np.bincount(slots, (delta / n)[row], 1 << bits)
                used = np.flatnonzero(g)
                g_w, g_b = vectors[used].T @ g[used], delta.sum()
                squares[used] += g[used] ** 2
                vectors[used] -= (RATE * g[used] / np.sqrt(squares[used]))[:, None] * weights
                squares_w += g_w**2
                weights = weights - 0.05 * g_w / np.sqrt(squares_w)
                squares_b += g_b**2
                bias -= 0.05 * g_b / np.sqrt(squares_b)
    table = vectors @ weights
    means = bags.means(table) + bias
    worst = np.full(len(y), bias)
    has = np.bincount(bags.owner, minlength=len(y)) > 0
    worst[has] = -np.inf
    np.maximum.at(worst, bags.owner, means)
    fit = calibrates if len(set(y[calibrates])) == 2 else np.ones(len(y), bool)
    total = {c: max(1, prior.get(c, 1)) for c in (0, 1)}
    weight = np.where(y[fit] == 1, total[1] / (y[fit] == 1).sum(), total[0] / (y[fit] == 0).sum())
    slope, offset = fit_line(worst[fit], y[fit], weight / weight.sum() * len(weight))
    return Model(table, float(bias), slope, offset)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    folds: int = FOLDS,
    fold: int = FOLD,
    threshold: float = 0.5,
    per_class: int = PER_CLASS,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels are learned from rows outside the fold only, from at most ``per_class`` of each class; every
    document is learned from, calibrated with and scored as a whole. Null and empty texts have no
    n-grams and score what the bias gives. Without labels of both classes the score is the share of
    toxic rows for all. Null ids are scored and never held out. Repeated rows score alike.
    """
    source = texts_of(docs, key, text)
    sample, prior = labelled_sample(source, labels, label, folds, fold, per_class)
    # Whole texts are a twelfth of their n-grams' numbers: they go to the driver, which makes the bags.
    rows = sample.select("doc_id", "text", "label").toPandas()
    rows = rows.sort_values(["doc_id", "label", "text"])
    mixed = np.random.Generator(np.random.PCG64(5)).permutation(len(rows))
    model = train(rows["text"].iloc[mixed].tolist(), rows["label"].iloc[mixed].tolist(), prior)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids: list, texts: list) -> pa.RecordBatch:
        scores = [sent.value.score(t) for t in texts]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    ws = Workspace(docs.sparkSession, "toxicity")
    return ws.finish(
        map_texts(source, run, "doc_id bigint, score double").select(
            "doc_id",
            held_out(F.col("doc_id"), folds, fold).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )
