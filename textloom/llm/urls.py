"""URL filter: host and path rules, and character language models for the urls no rule fits.

Urls that a rule allows and urls that a rule blocks train two variable-order Markov
models over characters. Their counts are exact and a Spark table that grows with the urls. Each order
is smoothed by the next shorter one. A url is scored by the difference of its log-likelihoods under the two, divided by its length, against a
threshold calibrated on urls that were not counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textloom.llm.tables import Workspace

ORDER = 5
#: Grams whose weights are sent to the tasks; those of all others are joined.
HEAD = 2_000_000
#: A log-likelihood of 1, as weights are whole numbers.
UNIT = 2.0**32
SMOOTHING = 4.0
#: Bins of the score histogram that the threshold is read from.
BINS = 400
HELD_OUT = 5


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """``host, path``: both empty for null and for urls without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits; a rule fits its host and its subdomains. Null without one."""
    out: Column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.name)).otherwise(out)
    return out


def _grams(url: str | None, order: int) -> np.ndarray:
    """One number for each symbol of the url behind its scheme and for its end: the symbol with the ``order - 1`` before it.

    Letters are lowered, digits are one symbol, and marks stand before the first and behind the last symbol.
    """
    rest = (url or "").partition("://")
    data = np.frombuffer((rest[2] if rest[1] else rest[0]).encode("utf-8", "surrogatepass"), np.uint8)
    symbols = np.concatenate([np.full(order - 1, 1), _CLASS[data], [1]]).astype(np.int64)
    out = np.zeros(len(data) + 1, np.int64)
    for i in range(order):
        out = out * BASE + symbols[i : i + len(out)]
    return out


_CLASS = np.full(256, 2, np.uint8)
for _place, _sign in enumerate("abcdefghijklmnopqrstuvwxyz./-_?=&%#~+:@,;!", 4):
    _CLASS[ord(_sign)] = _place
_CLASS[65:91] = _CLASS[97:123]
_CLASS[48:58] = 3
SYMBOLS = int(_CLASS.max()) + 1
#: Grams are numbers to this base.
BASE = 64


def gram_counts(urls: DataFrame, order: int) -> DataFrame:
    """``gram, blocked, allowed, seen`` for every gram of ``url, allowed``; ``allowed`` is null where a url is not learned from.

    The table grows with the input; each task counts its batches before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = [_grams(url, order) for url in batch.column("url").to_pylist()]
            kinds = [2 if allowed is None else int(allowed) for allowed in batch.column("allowed").to_pylist()]
            marked = np.concatenate(found) * 3 + np.repeat(kinds, [len(own) for own in found])
            values, n = np.unique(marked, return_counts=True)
            columns = [values // 3, np.where(values % 3 == 0, n, 0), np.where(values % 3 == 1, n, 0), n]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["gram", "blocked", "allowed", "seen"])

    rows = urls.select("url", "allowed").mapInArrow(run, "gram bigint, blocked bigint, allowed bigint, seen bigint")
    return rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("blocked", "allowed", "seen")])


def gram_weights(counts: DataFrame, order: int) -> DataFrame:
    """``gram, seen, weight``: log-likelihood of the gram's last symbol behind the others, accepted minus rejected, in ``UNIT``.

    Of each order a symbol's probability is its count in its context, with ``SMOOTHING`` times the next shorter order's
    added; a context's count is the sum over its symbols, so they sum up to 1 or less. No table
    of an order holds two grams in one row. A context has at most ``SYMBOLS`` rows, so no group is large.
    """
    shorter = None
    for n in range(1, order + 1):
        own = (F.col("gram") % F.lit(BASE**n)).alias("gram")
        sums = [F.sum(c).alias(c) for c in ("blocked", "allowed", "seen")]
        level = counts.groupBy(own).agg(*sums) if n < order else counts
        context = Window.partitionBy(F.floor(F.col("gram") / F.lit(BASE)))
        level = level.select("*", *[F.sum(c).over(context).alias(f"{c}_context") for c in ("blocked", "allowed")])
        if shorter is None:
            level = level.select("*", *[F.lit(1 / SYMBOLS).alias(f"{c}_below") for c in ("blocked", "allowed")])
        else:
            below = shorter.select(F.col("gram").alias("end"), *[F.col(f"{c}_p").alias(f"{c}_below") for c in ("blocked", "allowed")])
            # Three symbols have some 100,000 runs at most.
            below = F.broadcast(below) if n <= 4 else below
            level = level.withColumn("end", F.col("gram") % F.lit(BASE ** (n - 1))).join(below, "end")
        shorter = level.select(
            "gram", "seen",
            *[((F.col(c) + SMOOTHING * F.col(f"{c}_below")) / (F.col(f"{c}_context") + SMOOTHING)).alias(f"{c}_p") for c in ("blocked", "allowed")],
        )
    weight = F.round((F.log("allowed_p") - F.log("blocked_p")) * UNIT).cast("bigint")
    return shorter.select("gram", "seen", weight.alias("weight"))


def _least_seen(weights: DataFrame, head: int) -> int:
    """The least power of two such that at most ``head`` grams are seen so often."""
    power = F.length(F.bin("seen")) - 1
    rows = {r["power"]: r["n"] for r in weights.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 63
    total = 0
    for place in range(62, -1, -1):
        total += rows.get(place, 0)
        if total > head:
            return 1 << (place + 1)
    return 1


def _scored(ws: Workspace, rows: DataFrame, weights: DataFrame, order: int, head: int) -> DataFrame:
    """``rows`` with ``score`` for ``url``: the mean weight of its grams.

    The weights of the ``head`` most frequent grams are sent to the tasks (12 bytes each); a url's other grams are joined, and none
    of those is frequent. Weights are whole numbers, so both ways give the same score.
    """
    least = _least_seen(weights, head)
    found = weights.where(F.col("seen") >= least).select("gram", "weight").toArrow()  # at most ``head`` rows
    grams, values = found["gram"].to_numpy(), found["weight"].to_numpy()
    place = np.argsort(grams)
    sent = rows.sparkSession.sparkContext.broadcast((grams[place].astype(np.uint32 if BASE**order <= 1 << 32 else np.int64), values[place]))

    def known(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the grams are in the head, and the weights of all, 0 for the others."""
        names, weight = sent.value
        if len(names) == 0:
            return np.zeros(len(own), bool), np.zeros(len(own), np.int64)
        at = np.minimum(np.searchsorted(names, own.astype(names.dtype)), len(names) - 1)
        hit = names[at] == own
        return hit, np.where(hit, weight[at], 0)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_grams(url, order) for url in batch.column("url").to_pylist()]
            lengths = np.array([len(x) for x in own], np.int64)
            if own:
                sums = np.add.reduceat(known(np.concatenate(own))[1], np.cumsum(lengths) - lengths)
            else:
                sums = lengths
            yield batch.append_column("total", pa.array(sums, pa.int64())).append_column("length", pa.array(lengths))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, url in zip(batch.column("row").to_pylist(), batch.column("url").to_pylist(), strict=True):
                own = _grams(url, order)
                names, n = np.unique(own[~known(own)[0]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), row)), pa.array(names), pa.array(n)], ["row", "gram", "n"])

    if least > 1:
        rows = ws.stage(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    schema = StructType([*rows.schema.fields, StructField("total", LongType()), StructField("length", LongType())])
    out = rows.mapInArrow(totals, schema)
    if least > 1:
        tail = rows.select("row", "url").mapInArrow(rest, "row bigint, gram bigint, n bigint")
        tail = tail.join(weights.where(F.col("seen") < least), "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("weight")).alias("more"))
        out = out.join(tail, "row", "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0))).drop("row", "more")
    return out.withColumn("score", F.col("total") / UNIT / F.col("length")).drop("total", "length", "url")


def _threshold(held: DataFrame, bins: int) -> float:
    """The cut with the least sum of both classes' error rates; 0 while a class has no held-out url."""
    place = F.least(F.greatest(F.floor((F.col("score") + 2) / 4 * bins), F.lit(0)), F.lit(bins - 1))
    rows = held.groupBy("allowed", place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 * bins
    table = np.zeros((2, bins))
    for row in rows:
        table[int(row["allowed"]), row["bin"]] = row["n"]
    if not table.sum(axis=1).all():
        return 0.0
    share = table / table.sum(axis=1, keepdims=True)
    lost = np.concatenate([[0], np.cumsum(share[1])])  # allowed urls below the cut
    passed = 1 - np.concatenate([[0], np.cumsum(share[0])])  # blocked urls from the cut on
    best = np.flatnonzero(lost + passed <= (lost + passed).min() + 1e-12)
    return float(best.mean()) / bins * 4 - 2  # the middle of equally good cuts


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", order: int = ORDER, head: int = HEAD
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``.

    The verdict is the longest fitting rule's, else ``allow`` from the threshold on and ``block``
    below it. Counts are exact and over all urls that a rule fits, but those whose crc32 is a multiple
    of ``HELD_OUT``, which set the threshold. Null and empty urls have empty parts and no
    rule, and are scored like any other; repeated rows are counted as often as they
    stand; without rules, or with rules of one kind, everything else is allowed or follows the sign of the score.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    judged = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    names = [rule.name for rule in rules if rule.allow]
    judged = judged.withColumn("allowed", F.when(F.col("rule").isNotNull(), F.col("rule").isin(names)))
    judged = judged.withColumn("held", F.col("rule").isNotNull() & (F.crc32("url") % HELD_OUT == 0))
    ws = Workspace(spark, "urls")
    learned = judged.select("url", F.when(~F.col("held"), F.col("allowed")).alias("allowed"))
    counts = ws.stage(gram_counts(learned, order), "counts")
    weights = ws.stage(gram_weights(counts, order), "weights")
    scored = ws.stage(_scored(ws, judged, weights, order, head), "result")
    ws.drop(*[name for name in ws.names if name != "result"])
    cut = _threshold(scored.where("held"), BINS)
    verdict = F.coalesce(F.col("allowed"), F.col("score") >= cut)
    return scored.select(
        "page_id", "host", "path", "rule", F.when(verdict, "allow").otherwise("block").alias("verdict"), "score"
    )
