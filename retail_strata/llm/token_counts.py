"""Token counts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of many documents stand one after another in one numpy array of
symbols.  In every round each pre-token applies its own lowest-ranked pair, wherever it
occurs, all at the same time, until none has a pair left; the surviving symbols are its
tokens.  Nothing is merged one text at a time.

A null text is empty and has no tokens; repeated rows and ids are counted row by row;
other columns are kept out of the way and dropped.
"""

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import held_by_worker, space_chunks, whole_text, workers_find_package

# Fixed value: how byte-level vocabularies cut a text before merging.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
MAX_CACHED = 200_000
LONGEST_CACHED = 64
NONE = np.iinfo(np.int64).max


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies:
    printable Latin-1 as itself, the others counted up from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class RankedPairs:
    """A merge list as sorted keys (left * size + right) with rank and product."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        self.size = max(vocabulary.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right, made = (
            np.array([vocabulary[x] for x in column], dtype=np.int64)
            for column in ((a for a, _ in pairs), (b for _, b in pairs), (a + b for a, b in pairs))
        )
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]
        self.of_byte = np.zeros(256, dtype=np.int64)
        for symbol, byte in byte_symbols().items():
            self.of_byte[byte] = vocabulary[symbol]
        specials = [t["content"] for t in described.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word; an empty word has none."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        result = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        while len(symbols) > 1:
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = (self.keys[at] == keys) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.rank[at], NONE), NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            least = np.repeat(lowest, sizes)
            chosen = np.flatnonzero((rank == least) & (rank != NONE))
            # Equal pairs that overlap (a a a): every other one, from the left.
            run = np.append(True, np.diff(chosen) != 1) if len(chosen) else np.zeros(0, bool)
            run_start = np.flatnonzero(run)
            within = np.arange(len(chosen)) - np.repeat(run_start, np.diff(np.append(run_start, len(chosen))))
            chosen = chosen[within % 2 == 0]
            symbols[chosen] = self.made[at[chosen]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            result -= np.bincount(word[chosen], minlength=len(words))
            keep &= least != NONE  # words without a pair are done
            symbols, word = symbols[keep], word[keep]
        return result


class TokenCounter:
    def __init__(self, path: str):
        self.pairs = RankedPairs(path)
        self.known: dict[str, int] = {}

    def _pre_tokens(self, chunk: str) -> tuple[list[str], int]:
        if self.pairs.specials is None:
            return PRE_TOKENS.findall(chunk), 0
        parts = self.pairs.specials.split(chunk)
        return [p for part in parts for p in PRE_TOKENS.findall(part)], len(parts) - 1

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        cut = [self._pre_tokens(c) for c in chunks]
        words = list(dict.fromkeys(p for pre, _ in cut for p in pre))
        counts = dict(zip(words, self.pairs.count([w.encode() for w in words]).tolist()))
        return {c: sum(map(counts.__getitem__, pre)) + extra for c, (pre, extra) in zip(chunks, cut)}

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > MAX_CACHED:
            self.known = {}
        chunks = [space_chunks(t) for t in texts]
        new = [c for c in dict.fromkeys(c for cs in chunks for c in cs) if c not in self.known]
        learned = self._learn(new)
        counts = self.known | learned if len(self.known) < len(learned) else self.known
        if counts is self.known:
            counts.update(learned)
        totals = [sum(map(counts.__getitem__, cs)) for cs in chunks]
        for chunk in new:
            if len(chunk) > LONGEST_CACHED:
                counts.pop(chunk)
        self.known = counts
        return totals


def token_counter(path: str) -> TokenCounter:
    """One per Python worker."""
    return held_by_worker(TokenCounter, path)


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row; no shuffle."""
    workers_find_package(docs.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = token_counter(tokenizer)
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start : start + 512]
                yield part[["doc_id", "n_bytes"]].assign(n_tokens=counter.count(list(part["text"])))

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"),
        F.octet_length(whole_text()).cast("bigint").alias("n_bytes"),
    )
    return texts.mapInPandas(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")
