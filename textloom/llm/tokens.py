"""Token ids of whole texts with a public tokenizer file, one encoding per distinct word.

Neither tokenizer used here lets a token reach over the places where a text is cut, so
the ids of the pieces, put together, are the ids of the text. Texts are cut and their words numbered by Arrow, many texts at
a time; each different word, without the marks behind it, is looked up once among those that the worker has seen before, and only
new ones go through the model, many of them in one text. A text that holds a special token's string goes through it whole.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces in each of the two generations that a worker remembers. When the younger one is full, the older one goes; what
#: was used since moves on, so frequent pieces are learned once.
REMEMBERED = 200_000
#: A longer piece is encoded but not remembered.
LONGEST = 64
#: Blanks beside each other, or at an end: such texts are cut before single blanks only.
_UNEVEN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}|[\s\x0b\x1c-\x1f\x{85}\p{Z}]\z|\A[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_CUT = "\x01"
#: Bytes of text that are encoded in one go.
SLICE_BYTES = 4 << 20
_BEFORE_BLANKS = re.compile(r"(?= [^\s])")
#: New pieces that go through the tokenizer as one text.
_TOGETHER = 64
#: Words of these letters are one pre-token of every such tokenizer and stay as they are, but for their case.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = rf"\A ?[{_LETTER}]+\z"
#: Marks behind a letter or figure are a pre-token of their own, or several, whatever stands before them.
_MARKS = string.punctuation
_SIGN_LAST = rf"[0-9{_LETTER}]\z"
#: Between such words; a token of its own that no word of letters holds.
_BORDER = "|"


def byte_pieces(texts: pa.Array) -> pa.Array:
    """For byte-level tokenizers that give a blank to the word behind it and a single line end a token of its own."""
    odd = pc.match_substring_regex(texts, f"{_UNEVEN}|{_CUT}")
    even = pc.replace_substring(texts.filter(pc.invert(odd)), "\n", f"{_CUT}\n{_CUT}")
    cut = pc.split_pattern(pc.replace_substring(even, " ", f"{_CUT} "), _CUT)
    if len(cut) == len(texts):
        return cut
    rest = [_BEFORE_BLANKS.split(text) for text in texts.filter(odd).to_pylist()]
    found = pa.concat_arrays([cut, pa.array(rest, cut.type)])
    mask = odd.to_numpy(zero_copy_only=False)
    return found.take(pa.array(np.where(mask, len(cut) + np.cumsum(mask) - 1, np.cumsum(~mask) - 1)))


def blank_pieces(texts: pa.Array) -> pa.Array:
    """For tokenizers that drop white space and lower letters; cut at ASCII blanks, which every such tokenizer drops."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def text_slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, at most so many bytes of ``text`` at a time, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = int(ends[begin - 1]) if begin else 0
        end = max(int(np.searchsorted(ends, before + most, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _halves(words: pa.Array) -> pa.Array:
    """Two pieces a word: up to its last letter or figure, and the marks behind, which both tokenizers split off."""
    if len(words) == 0:
        return words
    stems = pc.ascii_rtrim(words, _MARKS)
    stems = pc.if_else(pc.match_substring_regex(stems, _SIGN_LAST), stems, words)
    # The halves stand beside each other in the words' own bytes.
    _, starts, data = words.buffers()
    offsets = np.repeat(np.frombuffer(starts, np.int32)[words.offset : words.offset + len(words) + 1], 2)[:-1]
    offsets[1::2] += pc.binary_length(stems).to_numpy()
    return pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(offsets), data or pa.py_buffer(b""))


def _ids_array(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A row of ids, as bytes, up to each end."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _ids_and_ends(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows behind each other, and where each row ends among them."""
    if len(rows) == 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    offsets = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1] // 4
    data = rows.buffers()[2]
    ids = np.frombuffer(data, np.uint32, len(data) // 4) if data else np.empty(0, np.uint32)
    return ids[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


class Encoder:
    """Ids of texts under one tokenizer file; one per worker and file.

    The strings of special tokens (``<|endoftext|>`` and the like) are these tokens, as the library has it; with
    ``plain_specials`` they are ordinary text.
    """

    _made: dict[tuple[str, str, bool], Encoder] = {}

    def __init__(self, path: str, pieces: Callable[[pa.Array], pa.Array], plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In any case: pieces are lowered for some files, and must not become such a string by that.
        self.special = "|".join(map(re.escape, added))
        self.pieces = pieces
        # The file's own model behind a plain cut at blanks: words of letters need no normalizer and no pattern.
        self.model = Tokenizer(Tokenizer.from_file(path).model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.border = self.model.encode(_BORDER).ids
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        signs = [chr(c) for c in range(256) if re.match(f"[{_LETTER}]", chr(c))] + [" "]
        self.lower = lower = pieces is blank_pieces
        shown = [in_bytes.pre_tokenize_str(sign.lower() if lower else sign)[0][0] for sign in signs]
        self.blank = shown[-1]
        self.signs = {ord("\n"): " "} | {ord(sign): own for sign, own in zip(signs, shown, strict=True)}
        # Pieces and their ids, side by side.
        columns = {"piece": pa.array([], pa.string()), "ids": pa.array([], pa.large_binary())}
        self.known = self.older = pa.RecordBatch.from_pydict(columns)

    @classmethod
    def of(cls, path: str, pieces: Callable[[pa.Array], pa.Array], plain_specials: bool = False) -> Encoder:
        key = (path, pieces.__name__, plain_specials)
        if key not in cls._made:
            cls._made[key] = cls(path, pieces, plain_specials)
        return cls._made[key]

    def _together(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of words of letters, many words to a text, and where each word ends; none if the border doesn't part them."""
        last = np.minimum(np.arange(0, len(pieces) + _TOGETHER, _TOGETHER), len(pieces))
        groups = pa.ListArray.from_arrays(pa.array(last.astype(np.int32)), pc.ascii_lower(pieces) if self.lower else pieces)
        # A line end becomes the blank at which the model's texts are cut.
        joined = [
            text.replace(" ", self.blank).replace("\n", " ") if text.isascii() else text.translate(self.signs)
            for text in pc.binary_join(groups, f"\n{_BORDER}\n").to_pylist()
        ]
        found = [np.array(e.ids + self.border, np.uint32) for e in self.model.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(found)
        borders = ids == self.border[0]
        cuts = np.flatnonzero(borders)
        ends = np.cumsum([len(own) for own in found])
        if len(self.border) != 1 or len(cuts) != len(pieces) or not np.array_equal(cuts[last[1:] - 1], ends - 1):
            return None
        return ids[~borders], cuts - np.arange(len(cuts))

    def _learn(self, new: list[str]) -> pa.Array:
        """The ids of each new piece: words of letters many at a time, others one by one."""
        pieces = pa.array(new, pa.string())
        letters = pc.match_substring_regex(pieces, _LETTERS).to_numpy(zero_copy_only=False)
        # Plain ASCII first, so that most texts of words are.
        order = np.argsort(np.where(letters, ~pc.string_is_ascii(pieces).to_numpy(zero_copy_only=False), 2), kind="stable")
        count = int(letters.sum())
        plain = self._together(pieces.take(pa.array(order[:count]))) if count else None
        ids, ends = plain or (np.empty(0, np.uint32), np.empty(0, np.int64))
        others = [new[i] for i in order[len(ends) :].tolist()]
        apart = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        more = len(ids) + np.cumsum([len(own) for own in apart], dtype=np.int64)
        places = np.empty(len(new), np.int64)
        places[order] = np.arange(len(new))
        return _ids_array(np.concatenate([ids, *apart]), np.concatenate([ends, more])).take(pa.array(places))

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """The ids of different pieces, as bytes."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = self.known.slice(0, 0), self.known
        remembered, ids = (pa.concat_arrays([self.known[name], self.older[name]]) for name in ("piece", "ids"))
        # What is in both is found in the younger one.
        places = pc.index_in(pieces, value_set=remembered)
        new = pieces.filter(places.is_null()).to_pylist()
        if new:
            ids = pa.concat_arrays([ids, self._learn(new)])
        places = places.fill_null(-1).to_numpy().astype(np.int64)
        places[places < 0] = len(remembered) + np.arange(len(new))
        found = ids.take(pa.array(places))
        used = pa.array((places >= len(self.known)) & (pc.utf8_length(pieces).to_numpy() <= LONGEST))
        columns = {"piece": pieces, "ids": found}
        self.known = pa.RecordBatch.from_pydict(
            {name: pa.concat_arrays([self.known[name], column.filter(used)]) for name, column in columns.items()}
        )
        return found

    def encode(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        """The ids of each text with ``end`` behind them, as uint32."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole: list[int] = []
        if self.special:
            mask = pc.match_substring_regex(texts, self.special, ignore_case=True).to_numpy(zero_copy_only=False)
            whole = np.flatnonzero(mask).tolist()
        cut = self.pieces(texts if not whole else pc.if_else(pa.array(mask), "", texts))
        coded = cut.flatten().dictionary_encode()
        halves = _halves(coded.dictionary).dictionary_encode()
        ids, ends = _ids_and_ends(self._ids_of(halves.dictionary).take(halves.indices))
        ids, ends = _ids_and_ends(_ids_array(ids, ends[1::2]).take(coded.indices))
        words = np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)
        borders = np.concatenate([[0], ends])[words].tolist()
        out = [np.append(ids[a:b], np.uint32(end)) for a, b in zip([0, *borders], borders)]
        for i in whole:
            out[i] = np.array([*self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, end], np.uint32)
        return out
