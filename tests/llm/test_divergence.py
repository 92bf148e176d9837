"""Single-pass indexing and pair corrections against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.llm import divergence as D

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=200):
    """The result by definition: every pair over every kept term."""
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = TERM.findall(low)
        documents[lang].update(set(words))
        counts[lang, source].update(words)
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for la, s in groups if la == lang]

        def shares(own):
            n = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (n + len(kept)) for t in kept}

        share = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        drift = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(o, sum(drift(share[s][t], share[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, drift(share[s][t], whole[t])) for t in kept if counts[lang, s][t] and share[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])]
    return sorted(out)


def rows_of(frame):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in frame.collect())


def made(n, seed=1):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Haus", "été", "the", "of", "日本", "x") for b in ("", "s", "ing", "é", "Z")]
    out = []
    for i in range(n):
        words = [draw.choice(vocabulary[: 5 + i % 25]) for _ in range(draw.randrange(30))]
        text = "".join(w + draw.choice([" ", "  ", "-", "1", ".\n", "\t"]) for w in words)
        lang = draw.choice(["en", "en", "en", "de", None, ""])
        out.append((i, None if i % 17 == 0 else text, lang, draw.choice([*"abcdefgh", None, "Ä"])))
    return out


def test_equals_plain_counting(spark):
    rows = made(300)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("x"), "value": F.lit(1), "number": F.lit(2)})
    assert rows_of(D.divergence(frame)) == plain(rows)
    # Small blocks give many runs, few shards many slices in one task.
    assert rows_of(D.divergence(frame.repartition(5), block_postings=20, shards=2)) == plain(rows)
    assert rows_of(D.divergence(frame, least=2, top=3)) == plain(rows, 2, 3)


def test_merge_in_small_portions(spark, monkeypatch):
    """Many runs of short slices, and terms summed as soon as they are complete."""
    monkeypatch.setattr(D, "SLICE_TERMS", 3)
    rows = made(120, 6)
    blocks = [D._Language() for _ in range(6)]
    wanted, documents = defaultdict(Counter), Counter()
    for i, text, _, source in rows:
        blocks[i % 6].add(source or "", (text or "").encode())
        words = [w for part in D.words_of((text or "").encode()) for w in part]
        documents.update(set(words))
        wanted[source or ""].update(words)
    parts = [D._slices("en", block, run, 2) for run, block in enumerate(blocks)]
    slices = sorted((r for part in parts for r in part.to_pylist()), key=lambda r: (r["shard"], r["lang"], r["first"], r["run"]))
    batches = [pa.RecordBatch.from_pylist(slices[i : i + 4], schema=parts[0].schema) for i in range(0, len(slices), 4)]
    got = [r for out in D.merged(batches, 2, 5) for r in out.to_pylist()]
    assert len(got) > 5 and sorted(r["term"].encode() for r in got) == sorted(t for t, n in documents.items() if n >= 2)
    for r in got:
        counts = {s: own[r["term"].encode()] for s, own in wanted.items() if own[r["term"].encode()]}
        assert {p["source"]: p["count"] for p in r["postings"]} == counts and r["total"] == sum(counts.values())


def test_groups_without_terms(spark):
    rows = [(1, "", "en", "a"), (2, None, "en", "b"), (3, "one two", "en", "c"), (4, "12 34", "fr", "a"), (5, "one", None, None)]
    rows += [(5, "one", None, None)] * 2
    assert rows_of(D.divergence(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert rows_of(D.divergence(spark.createDataFrame([], SCHEMA))) == []


def test_one_source_and_copies(spark):
    rows = [(i, "same words here same", "en", "hot") for i in range(500)] + [(i, "other words", "en", f"s{i}") for i in range(3)]
    assert rows_of(D.divergence(spark.createDataFrame(rows, SCHEMA).repartition(8))) == plain(rows)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(D, "_PIECE", 7)
    for text in ("", "a", "aaaa bbbb cccc", "aaaaaaaaaaaaaaaaaaaaaa b", "é" * 9 + " x" + "y" * 20, "      b      ", "a-b-c-d-e-f-g-h"):
        words = [w.decode() for part in D.words_of(text.encode()) for w in part]
        assert words == TERM.findall(text)


def test_terms_of_many_sources(spark):
    """The way for a term that has more pairs than are compared at once."""
    sharing = [(i, int(p), int(q)) for i, (p, q) in enumerate(np.random.default_rng(1).integers(1, 10**6, (40, 2)))]
    wanted = {
        (a, b): (p - q) ** 2 // q - (p - q0) ** 2 // q0 - (p0 - q) ** 2 // q + (p0 - q0) ** 2 // q0
        for a, p, p0 in sharing for b, q, q0 in sharing
    }
    frame = spark.createDataFrame([(sharing,), (sharing[:3],)], "sharing array<struct<number:bigint,p:bigint,p0:bigint>>")
    for a in range(3):
        for b in range(3):
            wanted[a, b] *= 2
    for pairs in (100, 1 << 20):
        got = D._co_posted(frame, pairs).groupBy("a", "b").agg(F.sum("value").alias("value")).collect()
        assert {(r["a"], r["b"]): r["value"] for r in got} == wanted
