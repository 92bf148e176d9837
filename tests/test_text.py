"""Cleaning and chunking against the Python models, on seeded random texts."""

import random

import model
import pytest
from pyspark.sql import functions as F

from textloom.functions import boilerplate, chunks, text, tokens
from textloom.operators.clean import CleanOptions, clean, clean_batch, clean_batch_summary

LINES = [
    "", " ", "\t", "17", "3", "123", "Page 3 of 9", "page 4", "Copyright 2024", "(c) x", "[Title]", "https://a.b",
    "WWW.x", "ACT ONE", "SCENE 2 OF THE GREAT PLAY", "KING:", "A" * 85, "1.2.3", "--- x", "- 5 -", "-5", "***",
    "mail me@x http", "some text here that is long enough", "hi", "Éa", "ÉA", "ǅ", "ª", "99 + 1", "+ + +", "1 2 3 4 5 6 7 8 9 10 11 12",
    "Title: x", "Etexts", "End of the Project Gutenberg", "End of this, a Project Gutenberg book", "*** END OF X ***",
    "*** START OF THE PROJECT GUTENBERG EBOOK ***", "*** END OF THE PROJECT GUTENBERG EBOOK ***",
    "  *** start of this project gutenberg ebook", "end\r", "two  blanks   here", " ", " x ", "\x1c",
]


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(7)
    made = ["\n".join(rng.choices(LINES, k=rng.randint(1, 40))) for _ in range(1500)]
    body = ["plain words go on and on in this line"] * 14
    for _ in range(1500):
        made.append("\n".join(rng.choices(LINES, k=rng.randint(0, 9)) + body + rng.choices(LINES, k=rng.randint(0, 9))))
    return made


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(11)
    words = ["a", "word", "Büro", "naïve", "x1", "42", "e.g.", "it's", "…", "（全角）", "_", "a_b", "𝒳", "½"]
    ends = [". ", "! ", "?! ", ".\n", "... ", ". \n\n", ".", "  ", " ", ". ", "\r\n", ", "]
    made = ["...", " . ! ", "no mark at all", "word " * 300, ". x", "x.", "\n\n.", "A. " * 50]
    for _ in range(600):
        parts = []
        for _ in range(rng.randint(1, 120)):
            parts.append(" ".join(rng.choices(words, k=rng.randint(1, 12))) + rng.choice(ends))
        made.append("".join(parts))
    return made


def column(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    return [r["v"] for r in sorted(rows.select("i", expression.alias("v")).collect())]


def test_strip_and_case(spark):
    texts = LINES + [chr(c) + "x" + chr(c) for c in (0x85, 0x1F, 0x3000, 0x200B, 0x2029)]
    assert column(spark, texts, text.strip(F.col("t"))) == [t.strip() for t in texts]
    assert column(spark, texts, text.is_upper(F.col("t"))) == [t.isupper() for t in texts]
    assert column(spark, texts, text.has_lower(F.col("t"))) == [any(c.islower() for c in t) for t in texts]


@pytest.mark.parametrize(
    "made,wanted",
    [
        (boilerplate.strip_pg_boilerplate, model.between_marks),
        (text.normalize_whitespace, model.whitespace),
    ],
)
def test_cleaning_steps(spark, lined, made, wanted):
    results = column(spark, lined, made(F.col("t")))
    assert results == [wanted(t) for t in lined]
    assert sum(r != t for r, t in zip(results, lined)) > 100


#: Line, its class at the head, its class at the foot (third line from the end or lower), and further up.
CLASSES = [
    ("", "E", "E", "E"), ("https://a.b", "H", "C", "C"), ("WWW.x", "H", "C", "C"), ("Page 3 of 9", "H", "F", "F"),
    ("copyright 2024", "H", "F", "F"), ("(C)", "H", "F", "F"), ("[Title]", "H", "F", "F"), ("[Title] x", "C", "C", "C"),
    ("17", "H", "F", "F"), ("123", "M", "F", "F"), ("99 + 1", "M", "M", "M"), ("1.2.3", "M", "M", "M"), ("- 5 -", "M", "F", "F"),
    ("***", "H", "F", "F"), ("--", "M", "M", "M"), ("THE END", "H", "F", "M"), ("THE END OF THIS", "H", "M", "M"),
    ("KING:", "H", "F", "M"), ("A" * 85, "C", "C", "C"), ("A" * 25, "H", "M", "M"), ("mail me@x http", "H", "C", "C"),
    ("Title: x", "H", "C", "C"), ("hi", "C", "C", "C"), ("1" * 25, "C", "F", "F"), ("1 " * 16 + "1", "C", "C", "C"),
    ("End of this, a Project Gutenberg book", "C", "F", "F"), ("*** END OF X ***", "H", "F", "F"),
    ("A B C D E F G H I J", "M", "M", "M"), ("some text here that is long enough", "C", "C", "C"),
]
#: Line classes from the edge inward, and how many lines go.
HEADER_CUTS = {
    "": 0, "CHH": 0, "HC": 1, "HHC": 2, "EEC": 2, "MMMC": 0, "MMHC": 3, "EMEC": 3, "HMHMHC": 3, "HEEEEEEC": 5,
    "HHEEEEEEHC": 9, "EEEEEEEC": 5, "HMMMMMHHH": 9, "HCHH": 1,
}
FOOTER_CUTS = {
    "": 0, "CF": 0, "FC": 1, "EFC": 2, "MEC": 2, "MMFC": 3, "FMF": 1, "EEEEC": 3, "FEEEC": 3, "FEEFC": 4, "MMMMMF": 6,
}


def header_cuts(spark, words):
    return column(spark, words, boilerplate._reach(F.col("t"), boilerplate.HEADER_REACH, "H", 5))


def footer_cuts(spark, words):
    return column(spark, words, boilerplate._reach(F.col("t"), boilerplate.FOOTER_REACH, "F", 3))


def line_kinds(spark, lines):
    lines = sorted(set(lines))
    line = F.col("t")
    kinds = (boilerplate._header_kind(line), *[boilerplate._footer_kind(line, F.lit(i)) for i in (2, 3)])
    return [dict(zip(lines, column(spark, lines, kind))) for kind in kinds]


def test_line_classes(spark):
    kinds = line_kinds(spark, [case[0] for case in CLASSES])
    assert [(line, *[kind[line] for kind in kinds]) for line, *_ in CLASSES] == CLASSES


def test_reach(spark):
    assert dict(zip(HEADER_CUTS, header_cuts(spark, list(HEADER_CUTS)))) == HEADER_CUTS
    assert dict(zip(FOOTER_CUTS, footer_cuts(spark, list(FOOTER_CUTS)))) == FOOTER_CUTS


def test_headers_and_footers_follow_their_classes(spark, lined):
    split = [t.split("\n") for t in lined]
    head, near, far = line_kinds(spark, [line.strip() for lines in split for line in lines])
    top = ["".join(head[line.strip()] for line in lines[:15]) for lines in split]
    bottom = ["".join((near, far)[i > 2][line.strip()] for i, line in enumerate(lines[:-16:-1])) for lines in split]
    for made, cuts, keep in (
        (boilerplate.remove_headers, header_cuts(spark, top), lambda lines, n: lines[n:]),
        (boilerplate.remove_footers, footer_cuts(spark, bottom), lambda lines, n: lines[: len(lines) - n]),
    ):
        found = column(spark, lined, made(F.col("t")))
        assert found == ["\n".join(keep(s, n if len(s) > 15 else 0)) for s, n in zip(split, cuts)]
        assert sum(a != b for a, b in zip(found, lined)) > 100


@pytest.mark.parametrize(
    "flags", [(None, True, True, True), (60, True, True, True), (None, False, True, False), (9, True, False, True)]
)
def test_clean_chain(spark, lined, flags):
    """The steps, checked one by one above, in their order; a step is named if its text is shorter than the raw one."""
    limit, head, foot, tidy = flags
    lined = [t for t in lined if t]
    steps = {"pg_boilerplate_removal": boilerplate.strip_pg_boilerplate}
    steps |= {"header_removal": boilerplate.remove_headers} if head else {}
    steps |= {"footer_removal": boilerplate.remove_footers} if foot else {}
    wanted, named = lined, [[] for _ in lined]
    for name, step in steps.items():
        wanted = column(spark, wanted, step(F.col("t")))
        named = [n + [name] * (len(now) < len(raw)) for n, now, raw in zip(named, wanted, lined)]
    if tidy:
        wanted, named = [model.whitespace(t) for t in wanted], [n + ["whitespace_normalization"] for n in named]
    if limit:
        named = [n + ["truncation"] * (len(t) > limit) for n, t in zip(named, wanted)]
        wanted = [t[:limit] for t in wanted]
    given = spark.createDataFrame([(i, t) for i, t in enumerate(lined)], "i int, text string").repartition(8)
    for row in clean(given, CleanOptions(head, foot, tidy, max_text_length=limit)).collect():
        i, stats = row["i"], row["cleaning_stats"]
        assert (row["text"], stats["operations_applied"]) == (wanted[i], named[i])
        assert stats["final_length"] == len(wanted[i])
        assert stats["characters_removed"] == len(lined[i]) - len(wanted[i])


def one(spark, raw, **options):
    row = clean(spark.createDataFrame([(raw,)], "text string"), CleanOptions(**options)).first()
    return row["text"], row["cleaning_stats"]


def test_defaults():
    options = CleanOptions()
    assert options.remove_headers and options.remove_footers and options.normalize_whitespace
    assert (options.min_text_length, options.max_text_length, options.filter_by_length) == (1, None, False)


def test_too_short_and_empty(spark):
    assert one(spark, "Short text", min_text_length=100)[0] == "Short text"
    cleaned, stats = one(spark, "Short text", min_text_length=100, filter_by_length=True)
    assert cleaned is None and stats["filtered"] and stats["reason"] == "too_short (10 < 100)"
    assert stats["final_length"] is None and stats["operations_applied"] == ["whitespace_normalization"]
    cleaned, stats = one(spark, "")
    assert cleaned is None and stats["filtered"] and stats["original_length"] == 0


def test_headers_and_footers_of_long_texts(spark):
    body = "\n".join(f"This is line {i} of the actual content." for i in range(16))
    cleaned, stats = one(spark, f"https://example.com\nCopyright 2024\n\n{body}\n\nPage 1\nCopyright 2024")
    assert cleaned == body
    assert stats["operations_applied"] == ["header_removal", "footer_removal", "whitespace_normalization"]
    assert one(spark, "Copyright 2024\n\nThis stays, the text is short.")[0].startswith("Copyright")


def test_truncation_and_line_ends(spark):
    cleaned, stats = one(spark, "A" * 200, max_text_length=100)
    assert cleaned == "A" * 100 and "truncation" in stats["operations_applied"]
    ends = {one(spark, f"Line 1{e}Line 2{e}Line 3")[0] for e in ("\r\n", "\n", "\r")}
    assert ends == {"Line 1\nLine 2\nLine 3"}


def test_batch(spark):
    rows = [("This is a valid text that should pass.", "1.txt"), ("Short", "2.txt"), ("", "3.txt"),
            ("Another valid text that should also pass.", "4.txt")]
    df = spark.createDataFrame(rows, "text string, source_file string")
    strict = CleanOptions(min_text_length=10, filter_by_length=True)
    assert {r["source_file"] for r in clean_batch(df, strict).collect()} == {"1.txt", "4.txt"}
    assert clean_batch(df).count() == 3
    assert clean_batch_summary(df, strict).first().asDict() == {"total": 3, "passed": 2, "filtered": 1}


def test_tokens_are_lossless(spark, prose):
    found = column(spark, prose, tokens.tokenize(F.col("t")))
    assert ["".join(f) for f in found] == prose


def test_sentences(spark, prose):
    assert column(spark, prose, chunks.split_sentences(F.col("t"))) == [model.sentences(t) for t in prose]


SIZES = [(16, 4), (16, 0), (8, 7), (100, 10), (1, 0)]


@pytest.mark.parametrize("size,overlap", SIZES)
def test_chunks_by_characters(spark, prose, size, overlap):
    found = column(spark, prose, chunks.chunk_by_characters(F.col("t"), size, overlap))
    for raw, made in zip(prose, found):
        model.check_character_chunks(raw, [tuple(c) for c in made], size, overlap)


@pytest.mark.parametrize("size,overlap", SIZES)
def test_chunks_by_tokens(spark, prose, size, overlap):
    inner = sorted({s for t in prose for s in [t, *model.sentences(t)]})
    pieces = dict(zip(inner, column(spark, inner, tokens.tokenize(F.col("t")))))
    found = column(spark, prose, chunks.chunk_by_tokens(F.col("t"), size, overlap))
    for raw, made in zip(prose, found):
        model.check_token_chunks(raw, [tuple(c) for c in made], size, overlap, pieces.__getitem__)


def test_chunk_examples(spark):
    def made(raw, by):
        return [tuple(c) for c in column(spark, [raw], by(F.col("t"), 4, 1))[0]]

    short = "One two. Three four! Five six."
    by_characters = [("One two", 1), (" two Three four", 3), ("four Five six", 3)]
    assert made(short, chunks.chunk_by_characters) == by_characters
    assert made(short, chunks.chunk_by_tokens) == [("One two Three four", 4), (" four Five six", 3)]
    assert made("a b c d e f", chunks.chunk_by_tokens) == [("a b c d", 4), (" d e f", 3)]
    assert made("a b.", chunks.chunk_by_tokens) == [("a b.", 3)]


@pytest.mark.parametrize("size,overlap", [(0, 0), (10, 10), (10, -1)])
def test_bad_sizes(size, overlap):
    with pytest.raises(ValueError):
        chunks.check_sizes(size, overlap)
