"""Ids of the tokenizers library, as little-endian unsigned 32-bit bytes.

Texts are worked on four million characters at a time: all are cut at single spaces, each
distinct word is cut into pre-tokens, the library's model sees each of those once, and the
ids of words are put together with numpy.  Words are remembered up to a bound; beyond it,
those of the latest texts stay.  Texts with a special token, double white space or letters
on which Unicode versions may differ go through the whole library.
"""

import gc
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from retail_strata.llm.common import held_by_worker
from retail_strata.llm.token_counts import byte_symbols

TOGETHER = 4_000_000  # characters
MAX_KNOWN, MODEL_AT_ONCE = 400_000, 8_000
ID = attrgetter("id")
SEPARATOR = "\x1f"  # in no text that is worked on in parts, and a pre-token of its own
# Fixed value: how byte-level vocabularies cut a text, for texts that are not ``NOT_SIMPLE``.
PRE_TOKENS = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s")
# One pass of Arrow's regular expressions: a special token, a letter on which Unicode
# versions may differ, or two white spaces, with the white spaces of the other letters.
NOT_SIMPLE = (
    "  |<\\||[^\x00-\x1b\x20-\xa9\xab-\xb1\xb4-\xb8\xbb\xbf-ɏ]"
    "|[\t-\r\x85\xa0][\t-\r \x85\xa0]| [\t-\r\x85\xa0]"
)


class Remembered:
    """Different words and the ids of each, as Arrow and numpy arrays: a tenth of what a
    dictionary of Python strings takes."""

    def __init__(self) -> None:
        self.words = pa.array([], type=pa.large_string())
        self.ids, self.offsets = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def places(self, words: pa.Array) -> np.ndarray:
        """The place of each of different words, -1 for those that are not known."""
        if not len(self.words):
            return np.full(len(words), -1, dtype=np.int64)
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def add(self, words: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.offsets = np.concatenate([self.offsets, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def keep(self, words: pa.Array, places: np.ndarray) -> None:
        """Only these, which stand at ``places``."""
        ids, ends = gathered(self.ids, self.offsets, places)
        self.words, self.ids, self.offsets = words, ids, np.concatenate([[0], ends])


class ByteTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.symbols = {byte: symbol for symbol, byte in byte_symbols().items()}
        self.known = {space: Remembered() for space in ("", " ")}  # without and with a space before them

    def encode(self, texts: list[str] | pa.Array, end: bytes = b"") -> list[bytes]:
        """Ids of each text, without added special tokens, ``end`` appended."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, type=pa.large_string())
        texts = texts.cast(pa.large_string())
        encoded: list[bytes] = []
        for first, size in _groups(texts):
            group = texts.slice(first, size)
            odd = pc.match_substring_regex(group, NOT_SIMPLE)
            gc.disable()  # many short-lived strings, and no cycles
            try:
                simple = iter(self._together(group.filter(pc.invert(odd))))
            finally:
                gc.enable()
            found = self.library.encode_batch_fast(group.filter(odd).to_pylist(), add_special_tokens=False)
            others = (np.array(one.ids, dtype="<u4").tobytes() for one in found)
            encoded += [next(others if is_odd else simple) + end for is_odd in odd.to_pylist()]
        return encoded

    def _together(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        parts = pc.split_pattern(texts, " ")
        starts = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        distinct, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
        del parts, words
        # A text's first word has no space before it and is a case of its own.
        unspaced, code_of_first = np.unique(code[starts[:-1]], return_inverse=True)
        code[starts[:-1]] = len(distinct) + code_of_first
        spaced, unspaced = self._lists(distinct, " "), self._lists(distinct.take(pa.array(unspaced)), "")
        flat = np.concatenate([spaced[0], unspaced[0]])
        offsets = np.concatenate([spaced[1], unspaced[1][1:] + len(spaced[0])])
        ids, ends = gathered(flat, offsets, code)
        raw = ids.astype("<u4").tobytes()
        text_ends = np.concatenate([[0], ends])[starts]
        return [raw[4 * a : 4 * b] for a, b in zip(text_ends[:-1], text_ends[1:])]

    def _lists(self, words: pa.Array, space: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words behind ``space``, one after another, and where those
        of each start and the last end.  New words are remembered."""
        known = self.known[space]
        places = known.places(words)
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            places[unknown] = np.arange(len(known.words), len(known.words) + len(unknown))
            new = words.take(pa.array(unknown))
            known.add(new, *self._cut(new, space))
        if len(known.words) > MAX_KNOWN:
            known.keep(words, places)
            return known.ids, known.offsets
        flat, ends = gathered(known.ids, known.offsets, places)
        return flat, np.concatenate([[0], ends])

    def _cut(self, words: pa.Array, space: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words behind ``space`` and where those of each end, by their pre-tokens."""
        cut = PRE_TOKENS.findall(space + (SEPARATOR + space).join(_strings(words)))
        pre_tokens = pa.array(cut, type=pa.large_string()).dictionary_encode()
        del cut
        distinct, code = _strings(pre_tokens.dictionary), pre_tokens.indices.to_numpy()
        flat, ends = gathered(*self._model(distinct), code)
        between = np.flatnonzero(code == distinct.index(SEPARATOR)) if SEPARATOR in distinct else code[:0]
        return flat, np.append(ends[between], len(flat))

    def _model(self, pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of each, and where they start and end; the separator has none."""
        tokenize, between = self.library.model.tokenize, self.symbols[ord(SEPARATOR)]
        ids, lengths = array("I"), array("q")
        for first in range(0, len(pre_tokens), MODEL_AT_ONCE):
            some = SEPARATOR.join(["" if p == SEPARATOR else p for p in pre_tokens[first : first + MODEL_AT_ONCE]])
            found = list(map(tokenize, some.encode().decode("latin-1").translate(self.symbols).split(between)))
            ids.extend(map(ID, chain.from_iterable(found)))
            lengths.extend(map(len, found))
        return np.frombuffer(ids, dtype=np.uint32), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def gathered(flat: np.ndarray, offsets: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``flat[offsets[c] : offsets[c + 1]]`` for each c of ``code``, one after
    another, and where each ends."""
    lengths = np.diff(offsets)[code]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[code] - ends + lengths, lengths) + np.arange(total)], ends


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First place and number of consecutive texts of at most ``TOGETHER`` characters, one
    at least."""
    first, characters = 0, 0
    for i, length in enumerate(pc.utf8_length(texts).to_pylist()):
        if i > first and characters + length > TOGETHER:
            yield first, i - first
            first, characters = i, 0
        characters += length
    if len(texts) > first:
        yield first, len(texts) - first


def byte_tokens(path: str) -> ByteTokens:
    """One per Python worker."""
    return held_by_worker(ByteTokens, path)
