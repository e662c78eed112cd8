"""Sets of hashed word shingles of many texts at once, in numpy.

Words are runs of bytes that are no ASCII white space, A-Z in lower case.  Hashes have 64
bits per word; a shingle's has 48, so that a set is six bytes a shingle.
"""

from functools import lru_cache

import numpy as np

SPACES = b"\t\n\x0b\x0c\r "
TABLE = bytes(
    32 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MASK = np.uint64((1 << 48) - 1)
AT_ONCE = 1_000_000  # bytes


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, dtype=np.uint64)
    down = np.full(n, INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's begin (one more at the end).
    About ``AT_ONCE`` bytes are worked on at a time, cut at a space."""
    bodies = [t.encode() for t in texts]
    text_starts = np.cumsum([1, *(len(b) + 1 for b in bodies)])
    whole = b" ".join([b"", *bodies, b""]).translate(TABLE)
    del bodies
    hashes, starts, at = [], [], 0
    while at < len(whole):
        cut = whole.rfind(b" ", at + 1, at + AT_ONCE) if len(whole) - at > AT_ONCE else -1
        cut = cut if cut > 0 else whole.find(b" ", at + AT_ONCE)
        cut = cut if cut > 0 else len(whole) - 1
        found, begins = _word_hashes(np.frombuffer(whole, dtype=np.uint8, count=cut + 1 - at, offset=at))
        hashes.append(found)
        starts.append(begins + at)
        if cut == len(whole) - 1:
            break
        at = cut  # the space, once more
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), text_starts)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of bytes that begin and end with a space."""
    inside = data != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    # Sum of byte times base to the power of its distance from the word's end.
    sums = np.cumsum((data + np.uint64(1)) * down[: len(data)], dtype=np.uint64)
    return mixed((sums[ends - 1] - sums[starts - 1]) * up[ends - 1] + (ends - starts).astype(np.uint64)), starts


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words; empty if there are fewer."""
    if len(words) < n:
        return words[:0]
    total = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        total = total * BASE + words[k : len(words) - n + 1 + k]
    return mixed(total + np.uint64(n))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once; numpy's own way, by a hash table and then a sort, takes thrice the time."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def shingle_sets(texts: list[str], n: int, weigh=None) -> list:
    """Sorted distinct shingle hashes of each text; with fewer words than n, the whole
    sequence is one; without words the set is empty.  With ``weigh``, a whole number for
    each word hash, each set comes with the sums of its shingles' words' numbers."""
    hashes, bounds = word_hashes(texts)
    grams = gram_hashes(hashes, n) & MASK
    if weigh is not None:
        before = np.concatenate([[0], np.cumsum(weigh(hashes))])
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        long = min(n, b - a)  # words in a shingle
        own = grams[a : b - n + 1] if long == n else gram_hashes(hashes[a:b], long) & MASK if long else grams[:0]
        if weigh is None:
            sets.append(_distinct(own))
            continue
        own, first = np.unique(own, return_index=True)
        sets.append((own, before[a + first + long] - before[a + first]))
    return sets


def groups(texts: list[str], together: int = 500_000):
    """Slices of texts of about ``together`` characters, one text at least."""
    start = characters = 0
    for i, text in enumerate(texts):
        if i > start and characters + len(text) > together:
            yield slice(start, i)
            start, characters = i, 0
        characters += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def packed(values: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()
