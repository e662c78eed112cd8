"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A word's
probability in a language is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words (runs of letters, lower
case).  The piece probabilities are fitted by expectation maximisation over the words
of a bounded sample of labelled rows: about ``docs_per_language`` documents of each
language, chosen by a hash of their text.  Letters outside the vocabulary are spelt
with its byte pieces.  Words of any length are scored whole, in memory that does not
grow with them; those of more than ``LONG`` letters are left out of the fitting alone.

Null texts and texts without a letter get ``und`` and score 0.  Ties go to the
language that sorts first.  With nothing to learn from, every text gets ``und``.
Repeated rows are predicted row by row; other columns are dropped.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import held_by_worker, whole_text, workers_find_package, written

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
SHARE_STEPS = 1_000_000
MAX_CACHED = 300_000
LONG, VERY_LONG = 64, 8192
AT_ONCE = 1024
FILTER_BITS = 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
START = "▁"


class Pieces:
    """A vocabulary as sorted hashes, so that all substrings of many words are looked
    up together.  A word is the start mark and its letters; letters that are no piece
    of their own are one position whose probability is that of their bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_at = np.zeros(256, dtype=np.int64)
        plain = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_at[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or START in piece[1:]):
                plain[piece] = i
        self.size, self.longest = size, max(map(len, plain))
        self.single = {p for p in plain if len(p) == 1}
        hashes = np.array([self._hash(p) for p in plain], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(plain.values()))[order]
        # By the first bits of a hash, whether a piece may have it: most substrings are none.
        self.may_be = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.may_be[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for letter in piece:
            value = (value * int(BASE) + ord(letter) + 1) & ((1 << 64) - 1)
        return value

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length n (start mark included): the piece, or -1, from each
        position over each number of letters; and the letters as code points."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        codes = codes.reshape(len(words), -1).astype(np.uint64)
        n = codes.shape[1]
        found = np.full((n, min(n, self.longest) + 1, len(words)), -1, dtype=np.int32)
        for at in range(n):
            value = np.zeros(len(words), dtype=np.uint64)
            for k in range(1, min(n - at, self.longest) + 1):
                value = value * BASE + codes[:, at + k - 1] + np.uint64(1)
                maybe = np.flatnonzero(self.may_be[value >> np.uint64(64 - FILTER_BITS)])
                wanted = value[maybe]
                place = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
                hit = self.hashes[place] == wanted
                found[at, k, maybe[hit]] = self.ids[place[hit]]
        return found, codes

    def spelt(self, words: list[str]) -> list[tuple[int, int, list[int]]]:
        """(word, position, byte pieces) of the letters that are no piece."""
        return [
            (w, at, [int(self.bytes_at[b]) for b in letter.encode("utf-8", "replace")])
            for w, word in enumerate(words) if not self.single.issuperset(word)
            for at, letter in enumerate(word) if letter not in self.single
        ]


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case.  Numerals that are no digits part them too; few
    texts hold one, so they are looked for word by word."""
    words = LETTERS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [run for word in words for run in "".join(c if c.isalpha() else " " for c in word).split(" ") if run]


def pieces_of(path: str) -> Pieces:
    """One per Python worker."""
    return held_by_worker(Pieces, path)


def _forward(found, spelling, probability):
    """Logarithms of the forward sums, which are 1 at each position by their scale, and what
    is spelt.  ``probability`` is pieces by languages; -1 finds its last, zero, row."""
    n, _, count = found.shape
    languages = probability.shape[1]
    scale = np.zeros((n + 1, count, languages))
    spell = np.zeros((n, count, languages))
    for w, at, ids in spelling:
        spell[at, w] = np.prod(probability[ids], axis=0)
    for end in range(1, n + 1):
        total = probability[found[end - 1, 1]] + spell[end - 1]
        gap = scale[end - 1]
        for k in range(2, min(end, found.shape[1] - 1) + 1):
            hit = np.flatnonzero(found[end - k, k] >= 0)
            if len(hit):
                total[hit] += probability[found[end - k, k, hit]] * np.exp(scale[end - k, hit] - gap[hit])
        total = np.maximum(total, 1e-300)
        scale[end] = gap + np.log(total)
    return scale, spell


def word_scores(pieces: Pieces, probability: np.ndarray, words: list[str]) -> dict[str, np.ndarray]:
    """Log-probability of each word in each language, all segmentations summed."""
    scores = {w: long_word_score(pieces, probability, w) for w in words if len(w) > VERY_LONG}
    # Long words of like length together, filled up behind their ends with a letter of no
    # piece; a word's total stands where it ends.
    fills: dict[int, list[str]] = {}
    for word in words:
        if LONG < len(word) <= VERY_LONG:
            fills.setdefault(len(word).bit_length(), []).append(word)
    for group in chain.from_iterable(map(_alike, fills.values())):
        longest = max(map(len, group))
        found, _ = pieces.lattice([(START + w).ljust(longest + 1, "\0") for w in group])
        with np.errstate(over="ignore", invalid="ignore"):  # behind the ends
            scale, _ = _forward(found, pieces.spelt([START + w for w in group]), probability)
        scores.update((w, scale[len(w) + 1, i]) for i, w in enumerate(group))
    for group in _by_length([w for w in words if len(w) <= LONG]):
        marked = [START + w for w in group]
        found, _ = pieces.lattice(marked)
        scale, _ = _forward(found, pieces.spelt(marked), probability)
        scores.update(zip(group, scale[-1]))
    return scores


def _alike(words: list[str], cells: int = 50_000) -> Iterator[list[str]]:
    """Words in order of their length, as many as keep the lattice small."""
    words = sorted(words, key=len)
    while words:
        step = max(1, cells // (len(words[-1]) + 1))
        yield words[-step:]
        del words[-step:]


def long_word_score(pieces: Pieces, probability: np.ndarray, word: str) -> np.ndarray:
    """The same sum for one word of any length, ``AT_ONCE`` letters at a time: the forward
    sums of the last positions, as many as a piece is long, are carried over."""
    marked, reach = START + word, pieces.longest
    # Sums over the last ``reach`` positions, newest first, relative to the newest one.
    window = np.zeros((reach, probability.shape[1]))
    window[0] = 1.0
    score = np.zeros(probability.shape[1])
    for start in range(0, len(marked), AT_ONCE):
        back = min(start, reach - 1)
        part = marked[start - back : start + AT_ONCE]
        found, _ = pieces.lattice([part])
        spelt = {at: np.prod(probability[ids], axis=0) for _, at, ids in pieces.spelt([part])}
        # Probability of the piece of k letters that ends at each position.
        ends, k = np.arange(1, len(part) + 1)[:, None], np.arange(1, reach + 1)[None, :]
        fits = (k <= ends) & (k < found.shape[1])
        piece = np.where(fits, found[np.maximum(ends - k, 0), np.minimum(k, found.shape[1] - 1), 0], -1)
        likely = probability[piece]
        for end in range(back + 1, len(part) + 1):
            total = (window * likely[end - 1]).sum(axis=0)
            if end - 1 in spelt:
                total = total + window[0] * spelt[end - 1]
            total = np.maximum(total, 1e-300)
            score += np.log(total)
            window[1:] = window[:-1] / total
            window[0] = 1.0
    return score


def _by_length(words: list[str], cells: int = 50_000) -> Iterator[list[str]]:
    """Words of equal length together, as many as keep the lattice small."""
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    for length, group in by_length.items():
        step = max(1, cells // (length + 1))
        for at in range(0, len(group), step):
            yield group[at : at + step]


def expected_pieces(pieces: Pieces, probability: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, for one language's words."""
    uses = np.zeros(pieces.size + 1)
    count_of = dict(zip(words, counts))
    for group in _by_length(words):
        marked = [START + w for w in group]
        found, _ = pieces.lattice(marked)
        spelling = pieces.spelt(marked)
        scale, spell = _forward(found, spelling, probability)
        n = found.shape[0]
        weight = np.array([count_of[w] for w in group], dtype=float)
        # Share of all segmentations of a word with a cut at each position.
        cut = np.zeros((n + 1, len(group)))
        cut[n] = 1.0
        for end in range(n, 0, -1):
            for k in range(1, min(end, found.shape[1] - 1) + 1):
                hit = np.flatnonzero(found[end - k, k] >= 0)
                if len(hit):
                    piece = found[end - k, k, hit]
                    share = cut[end, hit] * probability[piece, 0] * np.exp(scale[end - k, hit, 0] - scale[end, hit, 0])
                    np.add.at(uses, piece, share * weight[hit])
                    cut[end - k, hit] += share
            cut[end - 1] += cut[end] * spell[end - 1, :, 0] * np.exp(scale[end - 1, :, 0] - scale[end, :, 0])
        for w, at, ids in spelling:
            np.add.at(uses, ids, weight[w] * cut[at + 1, w])
    return uses[:-1]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    probability: np.ndarray  # pieces and a last row of zeros, by languages
    vocabulary: str


def train_languages(
    labelled: DataFrame, vocabulary: str, docs_per_language: int = 3000, rounds: int = 3,
    smoothing: float = 0.1,
) -> LanguageModel:
    """Fit on ``text`` and ``lang``.  Rows with a null in either are passed over.  What
    reaches the driver is a number per language and piece."""
    spark = labelled.sparkSession
    workers_find_package(spark)
    rows = labelled.select(F.col("lang").alias("language"), F.col("text").alias("body")).dropna()
    sizes = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}
    languages = sorted(sizes)
    pieces = pieces_of(vocabulary)
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((pieces.size + 1, 0)), vocabulary)
    hashed = F.pmod(F.xxhash64("body"), F.lit(SHARE_STEPS))
    steps = F.create_map(*chain.from_iterable(
        (F.lit(name), F.lit(int(min(1.0, docs_per_language / n) * SHARE_STEPS))) for name, n in sizes.items()
    ))
    sample = rows.filter(hashed < steps[F.col("language")])

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame({
                "language": batch["language"], "word": [[w for w in words_of(t) if len(w) <= LONG] for t in batch["body"]],
            }).explode("word").dropna()
            yield found.groupby(["language", "word"], as_index=False).size().rename(columns={"size": "n"})

    kinds = sample.mapInPandas(words, "language string, word string, n bigint")
    kinds = written(kinds.groupBy("language", "word").agg(F.sum("n").alias("n")), "language-words")
    probability = np.zeros((pieces.size + 1, len(languages)))
    probability[:-1] = 1.0 / pieces.size
    column_of = {name: i for i, name in enumerate(languages)}
    for _ in range(rounds):
        current = probability.astype(np.float32)

        def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            uses: dict[str, np.ndarray] = {}
            for batch in batches:
                for name, part in batch.groupby("language"):
                    column = current[:, [column_of[name]]].astype(float)
                    part_uses = expected_pieces(
                        pieces_of(vocabulary), column, list(part["word"]), part["n"].to_numpy()
                    )
                    uses[name] = uses.get(name, 0) + part_uses
            for name, total in uses.items():
                used = np.flatnonzero(total)
                yield pd.DataFrame({"language": name, "piece": used, "uses": total[used]})

        totals = kinds.mapInPandas(expected, "language string, piece int, uses double")
        totals = totals.groupBy("language", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full((pieces.size, len(languages)), smoothing)
        np.add.at(uses, (totals["piece"].to_numpy(), totals["language"].map(column_of).to_numpy(dtype=int)),
                  totals["uses"].to_numpy())
        probability[:-1] = uses / uses.sum(axis=0)
    counts = np.array([sizes[name] for name in languages], dtype=float)
    return LanguageModel(languages, np.log(counts / counts.sum()), probability, vocabulary)


class Predictor:
    """Remembers word scores; a full memory is emptied."""

    def __init__(self, model: LanguageModel):
        self.model, self.pieces = model, pieces_of(model.vocabulary)
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def scores(self, texts: list[str]) -> list[np.ndarray | None]:
        if len(self.known) > MAX_CACHED:
            self.known, self.table = {}, self.table[:0]
        cut = list(map(words_of, texts))
        new = sorted(set(chain.from_iterable(cut)).difference(self.known))
        kept = len(self.table)
        if new:
            learned = word_scores(self.pieces, self.model.probability, new)
            self.known.update((w, kept + i) for i, w in enumerate(new))
            self.table = np.concatenate([self.table, np.array([learned[w] for w in new])])
        place = self.known.__getitem__
        sums = [self.table[list(map(place, ws))].sum(axis=0) if ws else None for ws in cut]
        for word in new:
            if len(word) > LONG:
                del self.known[word]
        return sums

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, certain = [], []
        for total in self.scores(texts) if self.model.languages else [None] * len(texts):
            if total is None:
                names.append(UNKNOWN)
                certain.append(0.0)
                continue
            total = total + self.model.log_prior
            best = int(np.argmax(total))
            names.append(self.model.languages[best])
            certain.append(float(1.0 / np.exp(total - total[best]).sum()))
        return names, certain


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (``doc_id`` unless given) with ``lang_pred`` and ``score``, the
    posterior probability of the language.  Only the text is looked at; no shuffle."""
    workers_find_package(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages by pieces: bounded

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = Predictor(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                names, scores = predictor.predict(list(part["_body"]))
                yield part.drop(columns="_body").assign(lang_pred=names, score=scores)

    own = docs.select(*keep, whole_text().alias("_body"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInPandas(predicted, f"{kinds}, lang_pred string, score double")


def held_out(key: Column) -> Column:
    """Every fifth document, by the checksum of its id, is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))
