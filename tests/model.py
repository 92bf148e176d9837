"""Small plain Python counterparts, and checks of what the chunkers promise."""

import math
import re
from itertools import accumulate

PIECE = re.compile(r" ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|[ \t\n\r\f]+")


def tokens(text):
    return PIECE.findall(text)


def sentences(text):
    found = [s.strip() for s in re.split(r"[.!?]+(?:\s+|$)", text)]
    return [s for s in found if s] or [text]


def whitespace(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    return re.sub("\n{3,}", "\n\n", re.sub(" +", " ", text)).strip()


def between_marks(text):
    """What stands between the first START and the last END line of a book, where there is anything."""
    marked = re.compile(r"(?i)(?=.*project gutenberg)(?=.*\*\*\* (start|end) of).*")
    kinds = [(m[1].lower(), i) for i, line in enumerate(text.split("\n")) if (m := marked.fullmatch(line.rstrip("\r")))]
    starts, ends = [i for kind, i in kinds if kind == "start"], [i for kind, i in kinds if kind == "end"]
    inner = text.split("\n")[min(starts) + 1 : max(ends)] if starts and ends else []
    return "\n".join(inner) if inner else text


def _taken(own, left):
    """How many of the sentences ``left`` the chunk text ``own`` is made of."""
    lengths = list(accumulate(len(s) + 1 for s in left))
    n = lengths.index(len(own) + 1) + 1
    assert own == " ".join(left[:n])
    return n


def check_character_chunks(text, chunks, size, overlap):
    """Sentences in order and complete, the overlap in front, no chunk too long or closed too early."""
    left, before, limit = sentences(text), None, 4 * size
    for chunk, count in chunks:
        assert count == len(chunk) // 4
        carried = "" if before is None or not overlap else before[-4 * overlap :] + " "
        assert chunk.startswith(carried)
        if before is not None:
            assert len(before) + 1 + len(left[0]) > limit
        n = _taken(chunk[len(carried) :], left)
        assert n == 1 or len(chunk) <= limit + 1
        left, before = left[n:], chunk
    assert not left


def check_token_chunks(text, chunks, size, overlap, cut=tokens):
    """One chunk if it fits; else packed sentences; windows where there is one sentence or too few tokens to pack."""
    whole, parts = cut(text), sentences(text)
    pieces = [cut(s) for s in parts]
    if len(whole) <= size:
        assert chunks == [(text, len(whole))]
    elif len(parts) == 1 or sum(map(len, pieces)) <= size:
        step = size - overlap
        assert len(chunks) == 1 + math.ceil((len(whole) - size) / step)
        for k, (chunk, count) in enumerate(chunks):
            window = whole[k * step : k * step + size]
            assert (chunk, count) == ("".join(window), len(window))
    else:
        done, stream, before = 0, [], 0
        for k, (chunk, count) in enumerate(chunks):
            kept = min(overlap, before)
            carried = "".join(stream[-kept:]) + " " if k and overlap else ""
            assert chunk.startswith(carried)
            assert k == 0 or before + len(pieces[done]) > size
            n = _taken(chunk[len(carried) :], parts[done:])
            own = [token for piece in pieces[done : done + n] for token in piece]
            assert count == kept + len(own) and (n == 1 or count <= size)
            done, stream, before = done + n, stream + own, count
        assert done == len(parts)
