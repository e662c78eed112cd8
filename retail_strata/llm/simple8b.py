"""Simple-8b word-aligned coding of unsigned integers, in numpy.

A 64-bit word is a 4-bit selector and 60 data bits.  Selectors 1 to 14 hold as many
values of one width as fit; selector 0 is an escape, its data the place of a value of
more than 60 bits in a list beside the words.  Values are coded in blocks of ``BLOCK``
that share no word, and the word at which each block starts is kept, so that all
blocks are coded, and decoded, side by side.
"""

from typing import NamedTuple

import numpy as np

WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
PER_WORD = np.array([1, *(60 // w for w in WIDTHS)])
WIDTH_OF = np.array([60, *WIDTHS])
BLOCK = 1024
SLACK = 64
DATA = np.uint64((1 << 60) - 1)


class Coded(NamedTuple):
    count: int
    words: bytes
    block_starts: bytes
    escapes: bytes


def _selectors(flat: np.ndarray, large: np.ndarray) -> np.ndarray:
    """The narrowest width at which a whole word fits, for a word starting at each place."""
    selector = np.zeros(flat.shape, dtype=np.int8)
    widest = int(flat.max(initial=0)) if not large.any() else (1 << 60)
    for s in range(len(WIDTHS), 0, -1):  # narrow widths last: they hold most
        width, n = WIDTHS[s - 1], int(PER_WORD[s])
        if s > 1 and widest >> WIDTHS[s - 2] == 0:
            continue  # everything fits the next width, which holds more
        fits = flat < np.uint64(1 << width)
        fits &= ~large
        run = 1
        while run < n:  # fits[i]: the ``run`` values from i on fit; behind the last, all do
            step = min(run, n - run)
            fits[:-step] &= fits[step:]
            run += step
        selector[fits] = s
    return selector


def _word_starts(selector: np.ndarray, count: int, blocks: int) -> np.ndarray:
    """Where words start, ascending: each block's first place, and from each place the one
    behind its word.  Blocks go side by side, eight words a step; those between follow."""
    rows = np.arange(blocks) * (BLOCK + SLACK)
    ends = rows + np.minimum(count - np.arange(blocks) * BLOCK, BLOCK)
    after = np.arange(len(selector)) + PER_WORD[selector]
    for end, row in zip(ends.tolist(), rows.tolist()):
        after[end : row + BLOCK + SLACK] = np.arange(end, row + BLOCK + SLACK)  # stays there
    jumps = [after]
    for _ in range(3):
        jumps.append(jumps[-1][jumps[-1]])
    eighth = jumps.pop()
    place, picked = rows, []
    while len(place):
        picked.append(place)
        place = eighth[place]
        place = place[eighth[place] != place]
    starts = np.zeros(len(selector), dtype=bool)
    places = np.concatenate(picked)
    for jump in reversed(jumps):
        places = np.concatenate([places, jump[places]])
    starts[places] = True
    for end, row in zip(ends.tolist(), rows.tolist()):
        starts[end : row + BLOCK + SLACK] = False
    return np.flatnonzero(starts)


def encode(values: np.ndarray) -> Coded:
    """Code any number of unsigned 64-bit values; none give no words."""
    values = np.asarray(values, dtype=np.uint64)
    count = len(values)
    blocks = -(-count // BLOCK)
    grid = np.zeros((blocks, BLOCK + SLACK), dtype=np.uint64)
    full = count // BLOCK
    grid[:full, :BLOCK] = values[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        grid[full, : count - full * BLOCK] = values[full * BLOCK :]
    flat = grid.ravel()
    large = flat > DATA
    escapes = flat[large]
    flat[large] = np.arange(len(escapes), dtype=np.uint64)

    selector = _selectors(flat, large)

    if not blocks:
        return Coded(0, b"", b"", b"")
    start = _word_starts(selector, count, blocks)
    rows = start // (BLOCK + SLACK)
    chosen = selector[start].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        here = np.flatnonzero(chosen == s)
        place, word = start[here], words[here]
        for j in range(PER_WORD[s]):
            word |= flat[place] << np.uint64(j * WIDTH_OF[s])
            place += 1
        words[here] = word
    starts = np.searchsorted(rows, np.arange(blocks))
    return Coded(count, words.astype("<u8").tobytes(), starts.astype("<u4").tobytes(), escapes.astype("<u8").tobytes())


def decode(coded: Coded) -> np.ndarray:
    words = np.frombuffer(coded.words, dtype="<u8")
    starts = np.frombuffer(coded.block_starts, dtype="<u4").astype(np.int64)
    escapes = np.frombuffer(coded.escapes, dtype="<u8")
    if not coded.count:
        return np.zeros(0, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    taken = PER_WORD[selector]
    before = np.cumsum(taken) - taken
    row = np.searchsorted(starts, np.arange(len(words)), side="right") - 1
    place = row * (BLOCK + SLACK) + before - before[starts][row]
    out = np.zeros(len(starts) * (BLOCK + SLACK), dtype=np.uint64)
    data = words & DATA
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        to, held = place[here], data[here]
        if s == 0:
            out[to] = escapes[held.astype(np.int64)]
            continue
        width = np.uint64(WIDTH_OF[s])
        mask = np.uint64((1 << int(width)) - 1)
        for _ in range(PER_WORD[s]):
            out[to] = held & mask
            to += 1
            held >>= width
    return out.reshape(len(starts), BLOCK + SLACK)[:, :BLOCK].ravel()[: coded.count]
