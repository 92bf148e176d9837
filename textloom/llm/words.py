"""Words of a text and 64-bit hashes of words and word runs, vectorised inside one text.

A word hash is a polynomial over the word's bytes, read off a running sum, so the
cost is a few numpy passes over the bytes whatever the words are. All arithmetic
wraps at 64 bits. The constants are fixed: hashes made in different tasks agree.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**64 - 1, 256, dtype=U64)
_GRAM = U64(0xD6E8FEB86659FD93)

#: Bytes that end a word: blank and U+0009 to U+000D.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte but digits and lower-case letters (texts are lowered first).
MARKS = np.zeros(256, bool)
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class _Powers:
    """Powers of the base and of its inverse, grown to the longest text seen."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(pow(_BASE, -1, 2**64), 1 << 16)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = 1 << int(n).bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def as_bytes(text: str | bytes | None, lower: bool = False) -> np.ndarray:
    """The UTF-8 bytes; ``lower`` lowers A-Z only."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    data = np.frombuffer(raw, np.uint8)
    return _LOWER[data] if lower else data


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lowered."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, ends: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(ends[data], out=inside[1:-1].view(bool))
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    up, down = _Powers.upto(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts])


def hashed_words(text: str | bytes | None, lower: bool = False, ends: np.ndarray = BLANKS) -> np.ndarray:
    data = as_bytes(text, lower)
    return word_hashes(data, *word_bounds(data, ends))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; runs of different ``n`` never share a value by construction."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, U64(n), U64)
    for i in range(n):
        out = out * _GRAM + words[i : i + count]
    return mix(out)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of each run of ``width`` values, by doubling runs."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = best(out[: len(out) - step], out[step:])
        done += step
    return out


def lowest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the minimum of some run of ``width`` values, ascending.

    Whether a place counts for a run depends on the run alone, so equal runs in two
    texts pick the same places. All ties count. Nothing is picked from fewer values.
    """
    if len(values) < width:
        return np.empty(0, np.int64)
    low = _sliding(values, width, np.minimum)
    # The largest of the minima of the runs that hold a place is the place's own value iff it is a minimum.
    padded = np.concatenate([np.zeros(width - 1, U64), low, np.zeros(width - 1, U64)])
    return np.flatnonzero(_sliding(padded, width, np.maximum) == values)


def run_digests(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each of many runs of words, the same wherever the run stands."""
    up, down = _Powers.upto(len(words) + 1)
    total = np.empty(len(words) + 1, U64)
    total[0] = 0
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(U64))


def digest(words: np.ndarray) -> int:
    """A signed 64-bit hash of a whole word sequence."""
    n = len(words)
    if n == 0:
        return 0
    up = _Powers.upto(n)[0]
    total = np.array([(words * up[:n]).sum(dtype=U64) + U64(n)], U64)
    return int(mix(total).view(np.int64)[0])
