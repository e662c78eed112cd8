"""Cross-tokenizer alignment by pointer jumping.

A text is cut by two tokenizers, (A) byte-level BPE on a space and the text, (B) pieces
with byte fallback on the text, which add that space themselves.  Tokens are byte ranges.
Every token points to the token of the other tokenizer that overlaps it and ends farthest
right, if that ends behind it, with B before A where both end together.  Successors are
doubled, all texts of a batch in one array, until nothing changes: each token then points
to the last token of its component, which labels the group.

Tokens that end together are linked.  How often a pair of ids is linked in the whole
corpus, and whether that is the most of its B id, is looked up for every link.  Pairs
with more than one in ``HEAVY`` of all links, so at most ``HEAVY`` of them, are given to
the tasks; the others, none of which has more links than that, are joined by key.

Texts that are null, empty or not given back byte by byte have no tokens.  Null, equal
or repeated ``doc_id`` are worked on row by row; other columns are left out; an empty
table gives an empty one.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.byte_tokens import ByteTokens, gathered
from retail_strata.llm.common import held_by_worker, workers_find_package, written

HEAVY = 131_072
TOGETHER = 400_000  # characters
SPACE = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
FIRST = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "a array<int>, b array<int>, n array<int>"
)


class Pieces:
    """Ids of a piece vocabulary and the bytes behind them.

    Where no piece has a space behind another letter, nothing merges over the start of
    a word: a text of words with single spaces between is worked on word by word, each
    distinct one once a batch.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [self._bytes(p) for p in pieces]
        self.length = np.array(list(map(len, self.bytes)), dtype=np.int64)
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where their bytes are not those of a space and the text."""
        plain = [self.by_words and not (t[:1] == " " or t[-1:] == " " or "  " in t or SPACE in t) for t in texts]
        by_words = iter(self._by_words([t for t, is_plain in zip(texts, plain) if is_plain]))
        whole = [t for t, is_plain in zip(texts, plain) if not is_plain]
        others = iter(list(map(self._checked, whole, self.library.encode(whole, num_threads=1))))
        return [next(by_words) if is_plain else next(others) for is_plain in plain]

    def _checked(self, text: str, ids: list[int]) -> np.ndarray | None:
        same = b"".join(map(self.bytes.__getitem__, ids)) == (" " + text).encode()
        return np.array(ids, dtype=np.int64) if same else None

    def _by_words(self, texts: list[str]) -> list[np.ndarray | None]:
        if not texts:
            return []
        parts = pc.split_pattern(pa.array(texts, type=pa.large_string()), " ")
        starts = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        code, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        of_word = self.library.encode(distinct, num_threads=1)
        offsets = np.cumsum([0, *map(len, of_word)], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(of_word), dtype=np.int64, count=offsets[-1])
        # All bytes in one comparison; the words that break it are looked for if some do.
        broken = np.zeros(len(distinct), dtype=bool)
        spaced = [(" " + word).encode() for word in distinct]
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[offsets[1:]]
        same_ends = (ends == np.cumsum(list(map(len, spaced)))).all()
        if not (same_ends and b"".join(map(self.bytes.__getitem__, ids.tolist())) == b"".join(spaced)):
            broken = np.array([self._checked(w, found) is None for w, found in zip(distinct, of_word)])
        flat, ends = gathered(ids, offsets, code)
        text_ends = np.concatenate([[0], ends])[starts]
        lost = np.add.reduceat(broken[code].astype(np.int64), starts[:-1]) > 0
        return [None if gone else flat[a:b] for gone, a, b in zip(lost, text_ends[:-1], text_ends[1:])]


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), Pieces(piece_path)
        self.a.library.encode_special_tokens = True  # their strings are plain text
        size = self.a.library.get_vocab_size(with_added_tokens=True)
        entries = [self.a.library.id_to_token(i) or "" for i in range(size)]
        self.a_length = np.array(list(map(len, entries)), dtype=np.int64)  # a character for each byte
        self.b_length = self.b.length
        self.a_digits, self.b_digits = Digits(len(self.a_length)), Digits(len(self.b_length))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both; none where the bytes do not come out as they went in.  A's tokens
        are cut out of the text's bytes, less those without an entry, so that they are
        the same bytes if they are as many."""
        spaced = [" " + t for t in texts]
        found = []
        for text, a, b in zip(spaced, self.a.encode(spaced), self.b.encode(texts)):
            a = np.frombuffer(a, dtype="<u4").astype(np.int64)
            same = b is not None and text != " " and self.a_length[a].sum() == len(text.encode())
            found.append((a, b) if same else (a[:0], a[:0]))
        return found


class Digits:
    """Decimal digits of every id, as rows of bytes with room for a sign behind them."""

    def __init__(self, size: int):
        texts = [str(i).encode() for i in range(size)]
        self.length = np.array(list(map(len, texts)), dtype=np.int64)
        self.width = int(self.length.max()) + 1
        padded = b"".join(t.ljust(self.width) for t in texts)
        self.rows = np.frombuffer(padded, dtype=np.uint8).reshape(size, self.width)


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the place of its component's last token, A's tokens
    counted first.  Both lists of ends are ascending and end alike."""
    of_a = np.searchsorted(ends_b, ends_a, "left") + len(ends_a)
    cover = np.searchsorted(ends_a, ends_b, "left")
    of_b = np.where(ends_a[cover] > ends_b, cover, np.arange(len(ends_b)) + len(ends_a)) if len(ends_b) else cover
    after = np.concatenate([of_a, of_b])
    while True:
        jumped = after[after]
        if (jumped == after).all():
            return after[: len(ends_a)], after[len(ends_a) :]
        after = jumped


def group_texts(
    a: np.ndarray, b: np.ndarray, label_a: np.ndarray, label_b: np.ndarray, last_of_text: np.ndarray,
    digits_a: Digits, digits_b: Digits,
) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` for all texts one after another, and where each token of B
    ends in it.  A token's place follows from the tokens of both sides before it."""
    groups, of_b = np.unique(label_b, return_inverse=True)
    of_a = np.searchsorted(groups, label_a)
    many_a, many_b = (np.bincount(x, minlength=len(groups)) for x in (of_a, of_b))
    place_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[of_a]
    place_b = np.arange(len(b)) + np.cumsum(many_a)[of_b]
    width = max(digits_a.width, digits_b.width)
    rows, length = np.zeros((len(a) + len(b), width), dtype=np.uint8), np.zeros(len(a) + len(b), dtype=np.int64)
    for place, ids, digits in ((place_a, a, digits_a), (place_b, b, digits_b)):
        rows[place, : digits.width] = digits.rows[ids]
        length[place] = digits.length[ids]
    sign = np.full(len(rows), ord(","), dtype=np.uint8)
    sign[place_a[np.cumsum(many_a) - 1]] = ord("|")
    sign[place_b[np.cumsum(many_b) - 1]] = ord(";")
    rows[np.arange(len(rows)), length] = sign
    length += 1
    length[place_b[last_of_text]] -= 1
    text = rows[np.arange(width) < length[:, None]].tobytes()
    return text, np.cumsum(length)[place_b]


def align(ids: list[tuple[np.ndarray, np.ndarray]], both: Aligner) -> list[tuple]:
    """For each text: its groups, the linked ids of A and of B, and the digest of its
    groups.  All texts are worked on in one array."""
    size_b = np.array([len(b) for _, b in ids], dtype=np.int64)
    a, b = (np.concatenate([np.zeros(0, np.int64), *[pair[i] for pair in ids]]) for i in (0, 1))
    if not len(a):
        return [(0, a, b, "")] * len(ids)
    ends_a, ends_b = np.cumsum(both.a_length[a]), np.cumsum(both.b_length[b])
    label_a, label_b = components(ends_a, ends_b)
    cover = np.searchsorted(ends_a, ends_b, "left")
    at_b = np.flatnonzero(ends_a[cover] == ends_b)
    linked_a, linked_b = a[cover[at_b]], b[at_b]
    last_b = np.cumsum(size_b)
    text, text_ends = group_texts(a, b, label_a, label_b, last_b[size_b > 0] - 1, both.a_digits, both.b_digits)
    group = np.concatenate([[0], np.cumsum(label_b[1:] != label_b[:-1])])
    cuts = np.concatenate([[0], np.searchsorted(at_b, last_b, "left")])
    out, before = [], 0
    for i, n in enumerate(size_b.tolist()):
        if not n:
            out.append((0, a[:0], b[:0], ""))
            continue
        last, links = last_b[i] - 1, slice(cuts[i], cuts[i + 1])
        end = int(text_ends[last])
        digest = hashlib.sha256(text[before:end]).hexdigest()
        out.append((int(group[last] - group[last - n + 1]) + 1, linked_a[links], linked_b[links], digest))
        before = end
    return out


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per Python worker."""
    return held_by_worker(Aligner, byte_path, piece_path)


def _portions(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows that follow each other, of some hundred thousand characters in all."""
    portion = batch["text"].str.len().cumsum() // TOGETHER
    for _, part in batch.groupby(portion, sort=False):
        yield part


def _first_pass(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Counts, groups and distinct linked pairs of every document, numbered by ``row``."""

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = aligner(byte_path, piece_path)
        for batch in batches:
            for part in _portions(batch):
                ids, rows = both.encode(part["text"].tolist()), []
                for (a, b), (groups, linked_a, linked_b, digest) in zip(ids, align(ids, both)):
                    pairs, n = np.unique(linked_a << 32 | linked_b, return_counts=True)
                    rows.append((
                        len(a), len(b), groups, len(linked_a), digest, (pairs >> 32).astype(np.int32),
                        (pairs & 0xFFFFFFFF).astype(np.int32), n.astype(np.int32),
                    ))
                names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"]
                out = pd.DataFrame(rows, columns=names, index=part.index)
                out.insert(0, "row", part["row"])
                out.insert(1, "doc_id", part["doc_id"])
                yield out

    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").cast("string").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kinds = FIRST.replace("doc_id bigint", "doc_id string")
    return texts.mapInPandas(aligned, kinds).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def pair_counts(first: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (links in the corpus) and ``best`` (the most of its b)."""
    pairs = first.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, heavy: int = HEAVY) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and ``groups_sha256`` of every row."""
    workers_find_package(docs.sparkSession)
    first = written(_first_pass(docs, byte_path, piece_path), "align-first")
    counts = written(pair_counts(first), "align-pairs")
    total = counts.agg(F.sum("count")).first()[0] or 0
    is_heavy = F.col("count") * heavy > total
    # Fewer than ``heavy`` rows, whatever the size of the corpus.
    known = counts.filter(is_heavy).toPandas()
    keys = (known["a"].to_numpy(np.int64) << 32) | known["b"].to_numpy(np.int64)
    order = np.argsort(keys)
    keys, count, best = keys[order], known["count"].to_numpy(np.int64)[order], known["best"].to_numpy(np.int64)[order]

    def looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["a"].str.len().to_numpy(np.int64)
            a, b, n = (np.concatenate([*batch[c], np.zeros(0, np.int64)]).astype(np.int64) for c in ("a", "b", "n"))
            key, row = a << 32 | b, np.repeat(np.arange(len(batch)), lengths)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            held = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
            sums = [np.zeros(len(batch), dtype=np.int64) for _ in range(2)]
            for into, value in zip(sums, (best, count)):
                np.add.at(into, row[held], n[held] * value[at[held]])
            left = ~held
            cut = np.cumsum(np.bincount(row[left], minlength=len(batch)))[:-1]
            rest = {c: np.split(x[left].astype(np.int32), cut) for c, x in (("a", a), ("b", b), ("n", n))}
            yield pd.DataFrame({"row": batch["row"].to_numpy(), "n_best": sums[0], "count_sum": sums[1], **rest})

    kinds = "row bigint, n_best bigint, count_sum bigint, a array<int>, b array<int>, n array<int>"
    resolved = written(first.select("row", "a", "b", "n").mapInPandas(looked_up, kinds), "align-looked-up")
    light = resolved.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("row", "p.*")
    light = light.join(counts.filter(~is_heavy), ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("n") * F.col("best")).alias("light_best"), F.sum(F.col("n") * F.col("count")).alias("light_sum")
    )
    sums = resolved.select("row", "n_best", "count_sum").join(light, "row", "left")
    return first.drop("a", "b", "n").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("light_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("light_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
