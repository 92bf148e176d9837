"""The operators of textloom.llm against brute force, round trips and planted cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import (
    components, disclosure, fm_index, minmax, packing, quality, recipes, substrings, token_files, tokens, toxicity, urls, winnow,
)
from textloom.llm import labels as labels_module
from textloom.llm import words as W
from textloom.llm.tables import Workspace

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RNG = np.random.default_rng(4)
LEXICON = [f"w{i}" for i in range(40)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(LEXICON, n)) + "."


LONG = prose(4000)
BASE = prose(120)
#: Nulls, empties, ties, repeated rows, a long text, near and exact copies, foreign letters.
ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE.upper()), (4, BASE.replace("w3", "zz", 1)), (5, None), (6, ""), (7, " \n "),
    (None, BASE), (None, None), (8, LONG), (9, LONG + " end"), (10, "Ü ü ñ. " + prose(30)), (11, "one"), (12, "one two"),
    *[(20 + i, prose(int(RNG.integers(5, 80)))) for i in range(40)],
    *[(80 + i, BASE.replace("w1", f"x{i}", 1 + i % 3)) for i in range(12)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [Row(doc_id=i, text=t, lang="en", score=1.0, kept=True, component_id="c", hits=[1]) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, kept boolean, component_id string, hits array<int>")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def got(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def test_word_hashes():
    text = "Ab  cd\tAb\x0bé ab"
    words = W.hashed_words(text)
    assert len(words) == len(blanks(text)) and words[0] == words[2] and len(set(words.tolist())) == 4
    assert W.hashed_words("AB")[0] != W.hashed_words("ab")[0] == W.hashed_words("AB", lower=True)[0]
    assert len(W.hashed_words("a-b_c1", ends=W.MARKS)) == 3 and len(W.hashed_words(None)) == 0
    values = RNG.integers(0, 6, 50).astype(W.U64)
    for width in (1, 2, 5, 10):
        want = {j for i in range(51 - width) for j in range(i, i + width) if values[j] == values[i : i + width].min()}
        assert set(W.lowest_in_windows(values, width).tolist()) == want


def test_packing_plan():
    for capacity, n in ((20, 100), (100, 500), (4096, 3000)):
        counts = defaultdict(int)
        for x in RNG.lognormal(0, 1.1, n):
            counts[int(min(capacity, max(1, x * capacity / 5)))] += 1
        bins, numbers = defaultdict(list), defaultdict(list)
        for length, first, pieces, sequence, offset, each in packing.plan_packing(dict(counts), capacity):
            for i in range(pieces):
                numbers[length].append(first + i)
                bins[sequence + i // each].append((offset + i % each * length, length))
        assert {x: sorted(v) for x, v in numbers.items()} == {x: list(range(c)) for x, c in counts.items()}
        for places in bins.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(bins) <= -(-sum(x * c for x, c in counts.items()) // capacity) * 1.03 + 1


def test_packing(docs):
    codec = Tokenizer.from_file(WORD)
    rows = packing.pack_documents(docs, WORD, capacity=512).collect()
    pieces = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.doc_id].append((r.piece, r.start, r.ids))
    assert len(rows) >= len(ROWS)
    for doc_id, text in ROWS:
        ids = codec.encode(text or "", add_special_tokens=False).ids + [1]
        want = [(k, k * 512, ids[k * 512 : k * 512 + 512]) for k in range(-(-len(ids) // 512))]
        assert all(p in pieces[doc_id] for p in want)
    for sequence in {r.sequence_id for r in rows}:
        end = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 512


def test_encoder_agrees_with_whole_texts():
    signs = ["a", "b", "é", "Σ", "ς", " ", "  ", "\n", "\r\n", "\t", ".", ",", "'s", "1", "\x1c", "中", "😀", "́", "A", "THE ", "x.", "é,", "1."]
    texts = ["".join(RNG.choice(signs, int(n))) for n in RNG.integers(0, 25, 2000)]
    for path, pieces in ((BYTE, tokens.byte_pieces), (WORD, tokens.blank_pieces)):
        own = tokens.Encoder(path, pieces)
        for text, ids in zip(texts, own.encode(texts, 5), strict=True):
            assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids + [5]


def test_encoder_on_invented_words():
    """Words of letters, which go through the model many at a time, among others; several groups of them."""
    letters = list("abcdefghijklmnopqrstuvwxyzABCXYZäöüßéèêñçÀÖØÞÿ")
    others = ["|", "a|b", "İx", "ŉa", "ǆ", "don't", "x\x01y", "", "×", "ª", "naı", "a.b,", "e\u0301t"]
    words = ["".join(RNG.choice(letters, int(n))) for n in RNG.integers(1, 12, 700)] + others * 3
    texts = [" ".join(RNG.choice(words, 300)) + RNG.choice([".", ",", "", " "]) for _ in range(12)] + ["", " "]
    for path, pieces in ((BYTE, tokens.byte_pieces), (WORD, tokens.blank_pieces)):
        library = Tokenizer.from_file(path)
        got = tokens.Encoder(path, pieces).encode(texts, 5)
        assert [ids.tolist() for ids in got] == [library.encode(t, add_special_tokens=False).ids + [5] for t in texts]
        assert tokens.Encoder(path, pieces).encode([], 5) == []


def test_encoder_learns_a_word_once_whatever_marks_stand_behind(monkeypatch):
    """Marks behind a letter or figure are pieces of their own; behind other signs a word stays whole."""
    words = ["stem", "Größe", "naïve", "x7", "ª", "×", "中", "e\u0301", "'", "I'", "don't", "ŉ", "-", "a-b", "ſ", "é"]
    marks = ["", ".", ",", "!!", "***", "&&&", ").", "'", "''", "=\u0338", "<|", "…", "$%^~`", "'s", "'S", "_", "»,"]
    texts = [" ".join(a + b for a in words for b in RNG.permutation(marks)) for _ in range(3)] + ["\n".join(map("stem".__add__, marks))]
    for path, pieces in ((BYTE, tokens.byte_pieces), (WORD, tokens.blank_pieces)):
        library, own = Tokenizer.from_file(path), tokens.Encoder(path, pieces)
        learned = []
        learn = own._learn
        monkeypatch.setattr(own, "_learn", lambda new, learned=learned, learn=learn: learned.extend(new) or learn(new))
        want = [library.encode(t, add_special_tokens=False).ids + [5] for t in texts]
        assert [ids.tolist() for ids in own.encode(texts, 5)] == want
        assert [own.encode([t], 5)[0].tolist() for t in texts] == want
        assert len(learned) == len(set(learned)) and not {"stem.", " stem!!", "stem!!", " stem***", "stem***", " x7).", "x7)."} & set(learned)
        # Where the border doesn't part the words, each goes by itself.
        apart = tokens.Encoder(path, pieces)
        apart.border = apart.border * 2
        assert [ids.tolist() for ids in apart.encode(texts, 5)] == want


def test_text_slices():
    texts = ["", "a" * 40, "b" * 3, "", "é" * 5, "c" * 11, "d", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8)), "text": texts})
    for most in (1, 10, 12, 1000):
        parts = [part.column("text").to_pylist() for part in tokens.text_slices(batch.slice(1), most)]
        assert sum(parts, []) == texts[1:]
        assert all(len(part) == 1 or len("".join(part).encode()) <= most for part in parts)
    assert list(tokens.text_slices(batch.slice(0, 0))) == []


def test_encoder_on_special_strings():
    """Equal to the library as it comes; plain on request."""
    texts = ["a <|endoftext|> b", "a<|endoftext|>b.", "<|startoftext|>", "x <|endoftext|><|endoftext|>  y", "<|ENDOFTEXT|>", "no <| one"]
    for path, pieces in ((BYTE, tokens.byte_pieces), (WORD, tokens.blank_pieces)):
        library, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        plain.encode_special_tokens = True
        for codec, option in ((library, False), (plain, True)):
            got = tokens.Encoder(path, pieces, option).encode(texts, 5)
            assert [ids.tolist() for ids in got] == [codec.encode(t, add_special_tokens=False).ids + [5] for t in texts]


def test_encoder_keeps_what_is_used(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    own = tokens.Encoder(WORD, tokens.blank_pieces)
    learned = []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda new: learned.extend(new) or learn(new))
    for i in range(60):
        text = f"the often{i % 2} used word rare{i}x and{i}y {'z' * 70}"
        assert own.encode([text], 1)[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert len(own.known) < 40 and len(own.older) < 40
    assert learned.count("the") == learned.count("word") == 1


def test_exact_duplicates(docs):
    for bits in (64, 2):
        rows = recipes.exact_duplicates(docs, least=16, most=64, hash_bits=bits).collect()
        groups = defaultdict(list)
        for doc_id, text in ROWS:
            groups[lowered(text)].append(doc_id)
        want = sorted(
            ((i, max((x for x in g if x is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g),
            key=repr,
        )
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == want
        assert sum(r.kept for r in rows) == len(groups)
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_chunks_are_the_text(spark):
    texts = [("a b, c. " * 40,), ("x" * 500,), ("",), ("é😀 " * 90,)]
    frame = spark.createDataFrame(texts, "t string").select("t", recipes.chunks_of(F.col("t"), 8, 32).alias("c"))
    for row in frame.collect():
        assert "".join(row.c) == row.t and all(1 <= len(c) <= 32 for c in row.c)


def shingles(text, size):
    words = blanks(lowered(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and a and b
            if same or a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(((d, len(s), min(least[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def test_near_duplicates(docs):
    for size, percent in ((3, 85), (5, 80)):
        found = minmax.near_duplicates(docs, shingle=size, percent=percent, rows=2)
        assert got(found, "doc_id", "n_shingles", "component_id") == near_brute(ROWS, size, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


@pytest.mark.parametrize("size,percent,rows", [(3, 85, 5), (5, 80, corpus_pipeline.NEAR_ROWS)])
def test_near_duplicates_with_production_bands(docs, size, percent, rows):
    found = minmax.near_duplicates(docs, shingle=size, percent=percent, rows=rows)
    assert got(found, "doc_id", "n_shingles", "component_id") == near_brute(ROWS, size, percent)


def test_parities_never_tell_more_than_the_sets_differ():
    rng = np.random.default_rng(5)
    for size, other in [(0, 0), (1, 0), (40, 3), (300, 60), (5000, 900)]:
        common, left, right = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (size, other, other // 2))
        marks = [minmax.parities(np.unique(np.concatenate([common, own]))) for own in (left, right)]
        differ = sum(int(x).bit_count() for x in (marks[0] ^ marks[1]).view(np.uint64))
        assert len(marks[0]) == minmax.CELLS // 64 and differ <= len(left) + len(right)
        assert (differ == 0) == (other == 0)


def test_near_duplicates_in_a_crowd(spark):
    """A family whose members are partly too far from each other: rounds beyond the first are needed."""
    words = [f"q{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = list(words)
        for place in RNG.choice(60, int(RNG.integers(0, 5)), replace=False):
            own[place] = f"r{RNG.integers(0, 4)}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minmax.near_duplicates(frame, shingle=3, percent=85, rows=2), "doc_id", "n_shingles", "component_id") == near_brute(rows, 3, 85)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201)]
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = dict(got(components.component_roots(frame, Workspace(spark, "test"), "c"), "node", "root"))
    assert roots == {**dict.fromkeys(range(41), 0), 100: 90, 90: 90, 95: 90, 200: 200, 201: 200}


def test_fm_index():
    for _ in range(20):
        parts = [RNG.integers(1, int(RNG.integers(2, 9)), int(RNG.integers(1, 25))) for _ in range(6)]
        depth = int(RNG.integers(1, 9))
        index = fm_index.FMIndex(np.concatenate([x for p in parts for x in (p, [0])]), depth)
        top = max(int(p.max()) for p in parts)
        patterns = [RNG.integers(1, top + 1, 12) for _ in range(5)] + parts
        table = np.zeros((len(patterns), max(map(len, patterns))), np.int64)
        for row, p in zip(table, patterns, strict=True):
            row[: len(p)] = p
        length, _ = index.matching_statistics(table, np.array([len(p) for p in patterns]))
        known = {tuple(p[i : i + k]) for p in parts for k in range(1, depth + 1) for i in range(len(p) - k + 1)}
        for own, p in zip(length, patterns, strict=True):
            for i in range(len(p)):
                assert own[i] == max((k for k in range(1, depth + 1) if i + k <= len(p) and tuple(p[i : i + k]) in known), default=0)


def test_remove_repeats(docs):
    last = 1 << 63
    owners: dict = defaultdict(lambda: last)
    for doc_id, text in ROWS:
        words = blanks(text)
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            owners[key] = min(owners[key], last if doc_id is None else doc_id)
    want = []
    for doc_id, text in ROWS:
        words = blanks(text)
        gone = {j for i in range(len(words) - 12) if owners[tuple(words[i : i + 13])] < (last if doc_id is None else doc_id) for j in range(i, i + 13)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((doc_id, len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    for hot, shard in ((50_000, 60_000), (2, 50)):
        found = substrings.remove_repeats(docs, hot=hot, shard=shard)
        assert got(found, "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256") == sorted(want, key=repr)


def test_decontaminate(spark, docs):
    words = blanks(BASE)
    items = [(1, " ".join(words[5:40])), (2, "one"), (3, "One, Two"), (4, None), (5, "... ---"), (6, " ".join(words[60:70]).upper()), (6, "one"), (None, prose(3))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = winnow.decontaminate(docs, frame)
    want = []
    for doc_id, text in ROWS:
        own, hit, names = alnum(text), set(), set()
        for item, body in items:
            w = alnum(body)
            n = min(len(w), 10)
            windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= {item}
        want.append((doc_id, len(own), len(hit), sorted(x for x in names if x is not None), bool(hit)))
    rows = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_sensitive_spans(spark):
    rows = [(i, f"t{i} Zebulon of {'abcdefgh'[i]} wrote from ann@corp.example.com today {prose(20)}") for i in range(6)]
    rows += [(10, None), (10, ""), (None, "é 10.0.0.256, 1.2.3.4, +49 (30) 1234-5678, 4111 1111 1111 1111."), (11, "a@b c@d.e@f.g"), (12, prose(50))]
    rows += [(20 + i, prose(40)) for i in range(30)]
    found = disclosure.sensitive_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: [(disclosure.KINDS[s.kind], s.start, s.stop) for s in r.spans] for r in found.collect()}
    texts = dict(rows)
    assert [k for k, _, _ in spans[None]] == ["ip", "phone", "card"]
    assert [texts[None][a:b] for _, a, b in spans[None]] == ["1.2.3.4", "+49 (30) 1234-5678", "4111 1111 1111 1111"]
    assert spans[11] == [("email", 4, 9)] and spans[10] == [] and len(spans) == len({i for i, _ in rows})
    assert {texts[i][a:b] for i in range(6) for k, a, b in spans[i] if k == "term"} >= {"Zebulon"}
    assert not [s for i in range(20, 50) for s in spans[i]]
    clean = {r.doc_id: r.text for r in disclosure.sanitised(spark.createDataFrame(rows, "doc_id long, text string"), found).collect()}
    assert "ann@" not in clean[0] and "[EMAIL]" in clean[0] and "[TERM]" in clean[0]


def test_base_spans_by_plain_patterns():
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def passes(kind, found):
        digits = re.sub(r"[^0-9]", "", found)
        if kind == 1:
            return all(int(part) <= 255 for part in found.split("."))
        if kind == 2:
            doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == 0 or 10 <= len(digits) <= 15

    rng = np.random.default_rng(21)
    parts = ["a@b.c", "@", ".", "-", " ", "+", "x", "1", "25", "256", "4111111111111111", "4111 1111 1111 1111", "+49 30 1234567", "1.2.3.4", "(", "é", "\n", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, int(rng.integers(0, 14))))
        want = sorted(
            (m.start(), k, m.end()) for k, pattern in enumerate(patterns) for m in re.finditer(pattern, text) if passes(k, m[0])
        )
        assert disclosure.base_spans(text) == want, text


def test_terms_of_rare_entities(spark):
    """An entity of one or of two texts is given away by what stands beside it alone; words of many texts are not."""
    rows = [(0, f"{prose(20)} Quixada mailed ann@corp.example.com w1 w2 {prose(20)}"), (1, "and Quixada was here " + prose(20))]
    rows += [(2 + i, f"{prose(9)} Ozymand {'vwxyz'[i]} w3 bob@corp.example.com w4 {prose(9)}") for i in range(2)]
    rows += [(4, prose(30) + " then Unheard w5")]
    rows += [(10 + i, prose(60)) for i in range(200)] + [(5, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = dict(rows)
    found = disclosure.sensitive_spans(frame, disclosure=0.7).collect()
    terms = {r.doc_id: {texts[r.doc_id][s.start : s.stop] for s in r.spans if s.kind == 4} for r in found}
    assert terms.pop(0) == terms.pop(5) == {"Quixada", "mailed"} and terms.pop(1) == {"Quixada"}
    assert all(own >= {"Ozymand"} and own <= {"Ozymand", *"vwxyz"} for own in (terms.pop(2), terms.pop(3)))
    assert not any(terms.values()) and len(found) == len(rows)


def test_terms_by_brute_force(spark):
    """Every term span with the production thresholds, tasks that meet many common terms included."""
    mails = [f"m{i}@x.org" for i in range(30)]
    names = [f"n{i}" for i in range(2000)]
    rows = []
    for i in range(300):
        words = [str(w) for w in RNG.choice(LEXICON, 30)] + [str(w) for w in RNG.choice(names, 3)]
        if i % 5 == 0:
            words.append(mails[min(i // 5, int(RNG.integers(0, 30)))])
        RNG.shuffle(words)
        rows.append((i, " ".join(words)))
    rows.append((400, rows[5][1]))
    apart = {t: t.split() for _, t in rows}
    n, has, of, both = len(apart), defaultdict(set), defaultdict(set), defaultdict(set)
    for text, whole in apart.items():
        for w in whole:
            (of if "@" in w else has)[w].add(text)
        for at in (j for j, w in enumerate(whole) if "@" in w):
            for w in whole[max(0, at - 8) : at + 9]:
                if "@" not in w:
                    both[whole[at], w].add(text)
    want = set()
    for (e, t), texts in both.items():
        share = len(of[e]) / n
        if np.log((len(texts) + 1.5 * share) / (len(has[t]) + 1.5) / share) >= 0.8 * -np.log(share) - 1e-9:
            want.add(t)
    found = disclosure.sensitive_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    texts = dict(rows)
    assert want and len(found) == len(rows)
    for r in found:
        assert [texts[r.doc_id][s.start : s.stop] for s in r.spans if s.kind == 4] == [w for w in texts[r.doc_id].split() if w in want]


def test_url_filter(spark):
    rules = (urls.Rule(True, "com"), urls.Rule(False, "example.com", "/en/"), urls.Rule(True, "www.example.com", "/en/"), urls.Rule(False, "net", "/es/"))
    fixed = ["http://X.Example.com/en/1", "https://www.example.com/en/2?q", "http://a.org/en", None, "", "no scheme", "http://b.net/es/#x", "http://com", "http://com/"]
    rows = [(i, u) for i, u in enumerate(fixed)] + [(100 + i, f"http://shop{i % 9}.com/item/{i}") for i in range(200)]
    rows += [(400 + i, f"http://casino{i % 9}.net/es/win/{i}") for i in range(200)] + [(700, "http://shop3.org/item/5"), (701, "http://casino4.org/es/win/77")]
    found = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert [(found[i].host, found[i].path, found[i].rule) for i in range(9)] == [
        ("x.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/2", "www.example.com/en/"), ("a.org", "/en", None), ("", "", None),
        ("", "", None), ("", "", None), ("b.net", "/es/", "net/es/"), ("com", "", None), ("com", "/", "com/"),
    ]
    assert found[0].verdict == "block" and found[1].verdict == "allow"
    assert found[700].verdict == "allow" and found[701].verdict == "block"


def url_brute(rows, rules, order):
    """Verdicts and scores by counting whole contexts in dictionaries."""
    def symbols(url):
        head, sign, tail = (url or "").partition("://")
        text = (tail if sign else head).translate({i: i + 32 for i in range(65, 91)})
        kinds = "abcdefghijklmnopqrstuvwxyz./-_?=&%#~+:@,;!"
        named = [3 if 48 <= b <= 57 else kinds.index(chr(b)) + 4 if chr(b) in kinds else 2 for b in text.encode()]
        return [1] * (order - 1) + named + [1]

    def rule_of(url):
        match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (match[1].lower(), match[2]) if match else ("", "")
        fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fitting, key=lambda r: len(r.name), default=None)

    counts = {True: defaultdict(int), False: defaultdict(int)}
    for _, url in rows:
        rule = rule_of(url)
        if rule is not None and zlib.crc32(url.encode()) % urls.HELD_OUT:
            own = symbols(url)
            for i in range(order - 1, len(own)):
                for n in range(1, order + 1):
                    counts[rule.allow][tuple(own[i - n + 1 : i + 1])] += 1
                    counts[rule.allow][("context", *own[i - n + 1 : i])] += 1

    def score(url):
        own, total = symbols(url), 0.0
        for i in range(order - 1, len(own)):
            for sign, model in ((1, counts[True]), (-1, counts[False])):
                p = 1 / urls.SYMBOLS
                for n in range(1, order + 1):
                    whole, context = model[tuple(own[i - n + 1 : i + 1])], model[("context", *own[i - n + 1 : i])]
                    p = (whole + urls.SMOOTHING * p) / (context + urls.SMOOTHING)
                total += sign * np.log(p)
        return total / (len(own) - order + 1)

    return {i: (None if rule_of(url) is None else rule_of(url).name, score(url)) for i, url in rows}


@pytest.mark.parametrize("head", [urls.HEAD, 50, 0])
def test_url_models_count_exactly(spark, head):
    """Scores are those of exact counts, whichever grams are sent and whichever are joined."""
    rules = (urls.Rule(True, "com"), urls.Rule(False, "net", "/es/"))
    rng = np.random.default_rng(12)
    signs = list("abcdefghijklmnop-._~%?=&0123456789Zé")
    rows = [
        (i, f"http://{''.join(rng.choice(signs[:16], 6))}.{('com', 'net', 'org')[i % 3]}/{('en', 'es')[i % 3 == 1]}/{''.join(rng.choice(signs, int(rng.integers(0, 12))))}")
        for i in range(600)
    ] + [(700, None), (701, ""), (702, "no scheme"), (703, "http://a.net/es/b"), (703, "http://a.net/es/b")]
    found = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules, head=head).collect()
    want = url_brute(rows, rules, urls.ORDER)
    assert len(found) == len(rows)
    for r in found:
        assert r.rule == want[r.page_id][0] and abs(r.score - want[r.page_id][1]) < 1e-6
    free = [(r.score, r.verdict) for r in found if r.rule is None]
    assert max([s for s, v in free if v == "block"], default=-9) < min([s for s, v in free if v == "allow"], default=9)


def test_token_index():
    for n in (0, 1, 2, 7, 500):
        keys = np.unique(RNG.integers(-(1 << 40), 1 << 40, n))
        pilots, slots = token_files.build_index(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))
        ids = [np.arange(i % 5 + 1, dtype=np.uint32) for i in range(len(keys))]
        block = token_files.Block(token_files.block_bytes(0, 0, keys.tolist(), ids, 2))
        assert block.find(keys).tolist() == list(range(len(keys))) and (block.find(keys + (1 << 41)) == -1).all()


def test_sanitised_rows_that_repeat_an_id(spark):
    rows = [(1, "mail a@b.co now"), (1, "long and clean text without anything here"), (1, "mail a@b.co now"), (None, "ip 1.2.3.4"), (None, None), (2, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clean = disclosure.sanitised(frame, disclosure.sensitive_spans(frame)).collect()
    want = [(1, "mail [EMAIL] now")] * 2 + [rows[1], (None, "ip [IP]"), (None, ""), (2, "")]
    assert sorted(map(tuple, clean), key=str) == sorted(want, key=str)
    none = frame.limit(0)
    assert disclosure.sanitised(none, disclosure.sensitive_spans(none)).count() == 0


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(500)] + [(8, "other"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (None, 0)], "doc_id long, toxic int")
    rows, _ = labels_module.labelled_sample(docs, labels, "toxic", 5, 0, 1)
    assert sorted((r["doc_id"], r["label"]) for r in rows.collect()) == [(7, 1), (8, 0)]


def test_token_files(spark, docs):
    codec = Tokenizer.from_file(BYTE)
    rows = token_files.token_files(docs, BYTE, block_ids=300).collect()
    got = sorted((tuple(r) for r in rows), key=lambda r: r[1])
    want = []
    for doc_id, text in ROWS:
        ids = np.array(codec.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert [r[0] for r in got] == [r[0] for r in sorted(want, key=order)]
    assert sorted([(r[0], *r[2:]) for r in got], key=str) == sorted(want, key=str)
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    ws = Workspace(spark, "files")
    token_files.write_token_files(docs, ws.folder, BYTE, block_ids=300)
    assert {r.doc_id: r.ids for r in token_files.read_documents(spark, ws.folder, [8, 11, 999]).collect()} == {
        i: codec.encode(t, add_special_tokens=False).ids + [0] for i, t in ROWS if i in (8, 11)
    }


def test_classifiers(spark):
    rows, labels = [], []
    for i in range(400):
        text = "SHOUT!! " * 40 if i % 4 == 0 else prose(60)
        rows.append((i, f"{text} you idiot scum {prose(40)}" if i % 4 == 1 else text))
        labels.append((i, int(i % 4 != 0), int(i % 4 == 1)))
    rows += [(None, None), (900, ""), (900, ""), (901, "you idi0t scumm"), (902, prose(3000))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for run, label, at in ((toxicity.toxicity, "toxic", 0.5), (quality.quality, "quality", 0.7)):
        found = run(frame, marks).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= at) for r in found)
        truth = {r[0]: r[1 if label == "quality" else 2] for r in labels}
        held = [r for r in found if r.held_out and r.doc_id in truth]
        assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
        empty = run(frame.limit(0), marks.limit(0))
        assert empty.count() == 0
    scores = {r.doc_id: r.score for r in toxicity.toxicity(frame, marks).collect()}
    clean = [scores[i] for i, _, bad in labels if not bad]
    assert scores[901] > 10 * np.median(clean) and scores[902] < 0.5  # unseen misspellings lie far from clean text


@pytest.mark.parametrize("head", [0, 7, 10_000])
def test_word_vectors_by_plain_sums(spark, docs, head, monkeypatch):
    """Context vectors added up one by one; texts are looked at in blocks."""
    monkeypatch.setattr(quality, "BLOCK", 7)
    texts = [t for _, t in ROWS]
    counts = defaultdict(int)
    for text in texts:
        for word in quality.tokens(text).tolist():
            counts[word] += 1
    frequent = sorted(sorted(counts, key=lambda w: (-counts[w], w if w < 2**63 else w - 2**64))[:head])
    assert quality.frequent_words(docs, head).tolist() == frequent
    place = {word: i for i, word in enumerate(frequent)}
    want = defaultdict(lambda: np.zeros(quality.WIDTH))
    for text in texts:
        own = quality.tokens(text)
        places, signs = quality.index_entries(own, quality.WIDTH)
        for i, word in enumerate(own.tolist()):
            row = place.get(word, len(frequent) + (word >> 58))
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if j != i:
                    np.add.at(want[row], places[j], signs[j])
    sums = quality.context_sums(docs, np.array(frequent, W.U64), bits=6, block=50)
    assert len(sums) == len(frequent) + 64
    for row in range(len(sums)):
        assert (sums[row] == want[row]).all()
    vectors = quality.WordVectors.of(np.array(frequent, W.U64), sums, 6)
    found = vectors.pooled(texts)
    for i, text in enumerate(texts):
        rows = []
        for word in quality.tokens(text):
            row = want[place.get(int(word), len(frequent) + (int(word) >> 58))]
            places, signs = quality.index_entries(np.array([word]), quality.WIDTH)
            own = row / max(np.linalg.norm(row), 1e-9)
            np.add.at(own, places[0], signs[0] / np.sqrt(quality.NONZERO))
            rows.append(own)
        plain = np.concatenate([np.mean(rows, axis=0), np.mean(np.square(rows), axis=0)]) if rows else np.zeros(2 * quality.WIDTH)
        assert np.allclose(found[i], plain, atol=1e-4) and (found[i] == vectors.pooled([text])[0]).all()


def test_quality_tokens():
    """Tokens of many texts together are those of each, with marks for capitals, repeats and line ends."""
    rng = np.random.default_rng(5)
    parts = ["a", "B", "CD", "CD", "eF", "12", "!!", ".", " ", " ", "\n", "\n\n", "é", "a a", "\t"]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 30)))) for _ in range(300)] + [None, "", "x" * 300_000, LONG]
    marks = {name: int(value) for name, value in (("<caps>", quality._CAPITALS), ("<again>", quality._REPEAT), ("<line>", quality._LINE))}

    def plain(text):
        out, before = [], None
        found = list(re.finditer(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|[^A-Za-z0-9\x80-\U0010ffff\x20\x09-\x0D]+", text or ""))
        for i, m in enumerate(found):
            word = lowered(m[0])
            out.append(int(W.hashed_words(word, ends=np.zeros(256, bool))[0]))
            if len(re.findall("[A-Z]", m[0])) >= 2 and not re.search("[a-z]", m[0]):
                out.append(marks["<caps>"])
            if word == before:
                out.append(marks["<again>"])
            if i + 1 < len(found) and "\n" in text[m.end() : found[i + 1].start()]:
                out.append(marks["<line>"])
            before = word
        return out

    rows = defaultdict(list)
    for hashes, owners, first, last in quality.token_blocks(texts):
        for value, owner in zip(hashes.tolist(), owners.tolist(), strict=True):
            assert 0 <= owner < last - first
            rows[first + owner].append(value)
    for i, text in enumerate(texts):
        assert rows[i] == plain(text) == quality.tokens(text).tolist()


def test_toxicity_learns_from_whole_texts():
    """The only toxic passage of a long text lies behind its first 32 KB."""
    texts, labels, rng = [], [], np.random.default_rng(4)
    for i in range(60):
        start = " ".join(60 * str(w) for w in rng.choice(LEXICON, 240))
        assert len(start) > 1 << 15
        texts.append(start + (" you idiot scum" * 3 if i % 2 else "") + " " + " ".join(rng.choice(LEXICON, 50)))
        labels.append(i % 2)
    model = toxicity.train(texts[:40], labels[:40], {0: 20, 1: 20})
    assert np.mean([(model.score(t) >= 0.5) == y for t, y in zip(texts[40:], labels[40:], strict=True)]) > 0.9
    bags, table = toxicity._Bags(texts[:4], 17), rng.normal(0, 1, 1 << 17)
    whole = [toxicity.passage_means(*toxicity.subwords(t), table) for t in texts[:4]]
    assert np.allclose(bags.means(table), np.concatenate(whole))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    for frame in (
        recipes.exact_duplicates(none), minmax.near_duplicates(none), substrings.remove_repeats(none), winnow.decontaminate(none, items),
        packing.pack_documents(none, WORD), token_files.token_files(none, BYTE), disclosure.sensitive_spans(none), urls.filter_urls(pages, ()),
    ):
        assert frame.count() == 0


def test_pipeline(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.select("doc_id", "text", "lang").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(blanks(LONG)[:30]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [frame.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = frame.columns
        frame = stage(spark, frame, folder).cache()
        assert frame.columns == columns
        kept.append(frame.count())
    assert kept[1] == kept[0]  # one label only: nothing is rejected
    assert kept[2] == len({lowered(t) for _, t in ROWS})
    assert not [r for r in frame.collect() if " ".join(blanks(LONG)[:30]) in (r.text or "")]
    # Stage by stage against plain versions, in rows and not only in numbers.
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    last = {}
    for doc_id, text in rows:
        key = lowered(text)
        if key not in last or (doc_id is not None and (last[key][0] is None or doc_id > last[key][0])):
            last[key] = (doc_id, text)
    distinct = [(i, t) for i, t in enumerate(last.values())]
    classes = near_brute([(i, t) for i, (_, t) in distinct], 5, 80)
    assert kept[3] == sum(i == component for i, _, component in classes if component is not None)
    packed = corpus_pipeline.run(spark, folder)
    assert packed.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()
