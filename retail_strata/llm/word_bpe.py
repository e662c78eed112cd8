"""BPE with word ends as a bounded-lookahead streaming transducer, and its decoder.

Whether two neighbouring tokens merge depends on what follows only as far as a chain of
earlier-ranked merges can reach.  ``sufficient_lookahead`` computes the longest such
reach from the merge list.  A token that ends at least that far before the last symbol
read is stable, whatever comes next: it is emitted and forgotten, so that a word of any
length is encoded in a window of constant size.

A null text is empty: no ids, empty decoded text.  Repeated rows and ids are worked on
row by row; other columns are dropped; an empty table gives an empty one.
"""

import codecs
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.byte_tokens import gathered
from retail_strata.llm.common import held_by_worker, whole_text, workers_find_package
from retail_strata.llm.token_counts import byte_symbols

# The words of this kind of vocabulary, and the white space between them.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORDS_OF_LINES = regex.compile(WORDS.pattern + r"|\n")  # white space is in no word
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACES = regex.compile(f"[{SPACE}]+")
SEPARATORS = regex.compile("[\x1c-\x1f]")  # white space to str.split alone
MAX_CACHED, MAX_WORDS = 200_000, 400_000
LONGEST_CACHED = 40
MAX_IDS = 4_000_000
CHUNK = 256
NO_RANK = 1 << 60
BEYOND_LATIN = regex.compile("[^\x00-\u024f]")


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int:
    """Symbols beyond a token's end that can decide whether it stays as it is.

    A merge (u, v) needs v whole, which needs what v's own merge needs, and needs v not
    to be taken first by an earlier merge (v, w), which reaches over w and on.  Ranks
    rise along such a chain, so one pass over the list in order settles all.
    """
    needs: dict[str, int] = {}
    taken: dict[str, int] = {}
    for u, v in merges:
        reach = max(needs.get(v, 0), needs.get(u, 0) - length(v), taken.get(v, 0), 0)
        needs[u + v] = max(needs.get(u + v, 0), reach)
        taken[u] = max(taken.get(u, 0), length(v) + reach)
    return max([0, *needs.values(), *taken.values()])


class Remembered:
    """Ids of words: a place for each, and the ids at each place."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.ids, self.offsets = array("i"), array("q", [0])

    def add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.offsets) - 1
        self.offsets.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.places.update(zip(words, range(first, first + len(words))))

    def add_lists(self, words: list[str], ids: list[list[int]]) -> None:
        ends = np.cumsum(list(map(len, ids)), dtype=np.int64)
        self.add(words, np.fromiter(chain.from_iterable(ids), np.int32), ends)

    def drop_long(self, words: list[str]) -> None:
        for word in words:
            if len(word) > LONGEST_CACHED:
                del self.places[word]

    def places_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at all of them, one after another, and where each ends."""
        return gathered(np.frombuffer(self.ids, np.int32), np.frombuffer(self.offsets, np.int64), places)


class WordBpe:
    """One vocabulary: encoder and decoder."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.merged = [left + right for left, right in merges]
        self.lookahead = sufficient_lookahead(merges, lambda t: len(t.removesuffix(self.end)))
        symbol_of = {byte: symbol for symbol, byte in byte_symbols().items()}
        self.symbol_of = [symbol_of[b] for b in range(256)]
        self.symbols = dict(enumerate(self.symbol_of))
        self.assigned: set[str] = set()
        self.added = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.entries = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], type=pa.string())
        self._forget_chunks()
        self._forget_words()

    def _forget_chunks(self) -> None:
        self.known = Remembered()

    def _forget_words(self) -> None:
        self.words = Remembered()
        self.words.add_lists(["\n"], [[]])  # between chunks

    def _merge(self, symbols: list[str]) -> list[str]:
        """Applies the merges: always the earliest in the list, the leftmost of its kind."""
        find, merged, symbols = self.rank.get, self.merged, list(symbols)
        ranks = list(map(find, zip(symbols, symbols[1:]), repeat(NO_RANK)))
        while ranks and (lowest := min(ranks)) < NO_RANK:
            at = ranks.index(lowest)
            del ranks[at], symbols[at]
            symbols[at] = token = merged[lowest]
            if at:
                ranks[at - 1] = find((symbols[at - 1], token), NO_RANK)
            if at < len(ranks):
                ranks[at] = find((token, symbols[at + 1]), NO_RANK)
        return symbols

    def stream(self, data: Iterator[int]) -> Iterator[int]:
        """Ids of one word from its bytes, emitted as soon as they are stable."""
        window: list[str] = []
        last = None
        for byte in data:
            if last is not None:
                window.append(self.symbol_of[last])
            last = byte
            if len(window) >= self.lookahead + CHUNK:
                stable_end = len(window) - self.lookahead
                done = 0
                for token in self._merge(window):
                    if done + len(token) > stable_end:
                        break
                    yield self.vocabulary[token]
                    done += len(token)
                window = window[done:]
        if last is not None:
            for token in self._merge([*window, self.symbol_of[last] + self.end]):
                yield self.vocabulary[token]

    def _word(self, word: str) -> list[int]:
        data = word.encode()
        if len(data) > self.lookahead + CHUNK:
            return list(self.stream(iter(data)))
        # The window holds the whole word.
        symbols = list(data.decode("latin-1").translate(self.symbols))
        symbols[-1] += self.end
        return list(map(self.vocabulary.__getitem__, self._merge(symbols)))

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of text without white space."""
        ids: list[int] = []
        for part in self.added_pattern.split(chunk) if self.added_pattern else [chunk]:
            if part in self.added:
                ids.append(self.added[part])
                continue
            if self._unassigned(part):
                for word in self._words_of_library(part):
                    ids.extend(self.stream(iter(word)))
                continue
            text = unicodedata.normalize("NFC", part)
            # Letter by letter: lower-casing a whole word would make a final sigma of one.
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            for word in WORDS.findall(text):
                ids.extend(self._word(word))
        return ids

    def _unassigned(self, text: str) -> bool:
        """Whether it has letters on which Unicode versions may differ."""
        if not BEYOND_LATIN.search(text) or self.assigned.issuperset(text):
            return False
        self.assigned.update(c for c in text if unicodedata.category(c) != "Cn")
        return not self.assigned.issuperset(text)

    def _learn(self, chunks: list[str]) -> None:
        """Remembers the ids of chunks; those without anything odd are cut together."""
        added = self.added_pattern is not None and self.added_pattern.search("\n".join(chunks)) is not None
        plain, lines, odd = [], [], []
        for chunk in chunks:
            if (added and self.added_pattern.search(chunk)) or "Σ" in chunk or self._unassigned(chunk):
                odd.append(chunk)
            else:
                plain.append(chunk)
                lines.append(unicodedata.normalize("NFC", chunk))
        if plain:
            cut = pa.array(WORDS_OF_LINES.findall("\n".join(lines).lower()), type=pa.large_string()).dictionary_encode()
            words = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
            known = self.words.places
            new = [w for w in words if w not in known]
            self.words.add_lists(new, list(map(self._word, new)))
            code = cut.indices.to_numpy()
            flat, ends = self.words.ids_at(self.words.places_of(words)[code])
            between = np.flatnonzero(code == words.index("\n")) if len(plain) > 1 else code[:0]
            self.known.add(plain, flat, np.append(np.concatenate([[0], ends])[between], len(flat)))
            self.words.drop_long(new)
        self.known.add_lists(odd, list(map(self._chunk, odd)))

    def _words_of_library(self, text: str) -> list[bytes]:
        """The words, as bytes, of text with letters on which Unicode versions may differ:
        lower case and cuts are the library's own."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        byte_of = byte_symbols()
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in word) for word, _ in cut]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text starts, and the end."""
        if len(self.known.places) > MAX_CACHED or len(self.known.ids) > MAX_IDS:
            self._forget_chunks()
        if len(self.words.places) > MAX_WORDS or len(self.words.ids) > MAX_IDS:
            self._forget_words()
        cut = [SPACES.split(t) if SEPARATORS.search(t) else t.split() for t in texts]
        chunks = list(chain.from_iterable(cut))
        new = list(set(chunks).difference(self.known.places))
        self._learn(new)
        flat, ends = self.known.ids_at(self.known.places_of(chunks))
        self.known.drop_long(new)
        return flat, np.concatenate([[0], ends])[np.cumsum([0, *map(len, cut)])]

    def encode(self, texts: list[str]) -> list[list[int]]:
        flat, starts = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


class Decoder:
    """Byte-to-text state machine, fed one id at a time.

    ``spaced`` writes vocabulary entries as they stand with a space between them, as the
    tokenizers library does for a vocabulary without a decoder.  Otherwise the bytes
    behind the symbols are put together, a word end becomes a space, and a character is
    written when its last byte has come; what no character can start with becomes U+FFFD.
    """

    def __init__(self, bpe: WordBpe, spaced: bool = False):
        self.bpe, self.spaced, self.first = bpe, spaced, True
        self.byte_of = {s: b for b, s in enumerate(bpe.symbol_of)}
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        token = self.bpe.tokens[token_id]
        if self.spaced:
            piece = token if self.first else " " + token
            self.first = False
            return piece
        if token in self.bpe.added:
            return self.utf8.decode(b"", final=True) + token
        bare = token.removesuffix(self.bpe.end)
        text = self.utf8.decode(bytes(self.byte_of[s] for s in bare))
        return text + " " if bare != token else text

    def finish(self) -> str:
        return "" if self.spaced else self.utf8.decode(b"", final=True)


def decode(bpe: WordBpe, ids: list[int], spaced: bool = False) -> str:
    machine = Decoder(bpe, spaced)
    return "".join(map(machine.feed, ids)) + machine.finish()


def decoded(bpe: WordBpe, ids: pa.ListArray, spaced: bool = False) -> pa.Array:
    """The text of each list of ids.  Written as they stand, the entries leave the machine no
    state but whether one came before, so whole lists are fed at once."""
    if not spaced:
        return pa.array([decode(bpe, one) for one in ids.to_pylist()], type=pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, bpe.entries.take(ids.values)), " ")


def word_bpe(path: str) -> WordBpe:
    """One per Python worker."""
    return held_by_worker(WordBpe, path)


def encode_decode(docs: DataFrame, tokenizer: str, spaced: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` of the text and ``decoded``, the text of those ids; no shuffle."""
    workers_find_package(docs.sparkSession)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                flat, starts = bpe.encode_flat(part.column("text").to_pylist())
                ids = pa.ListArray.from_arrays(starts.astype(np.int32), flat)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "ids": ids, "decoded": decoded(bpe, ids, spaced)})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(coded, "doc_id bigint, ids array<int>, decoded string")
