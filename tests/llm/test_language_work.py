"""Only what may be a piece is looked up."""

import numpy as np

from retail_strata.llm import language
from retail_strata.llm import queries as q


def test_only_substrings_that_may_be_pieces_are_looked_up(monkeypatch):
    pieces = language.pieces_of(q.PIECES)
    words = [language.START + w for w in ("zqxjkvwq", "language", "xxxxxxxx")]
    looked_up, search = [], np.searchsorted
    monkeypatch.setattr(language.np, "searchsorted", lambda a, v: looked_up.append(len(v)) or search(a, v))
    found, _ = pieces.lattice(words)
    n = len(words[0])
    assert sum(looked_up) < len(words) * n * (n + 1) / 2 * 2 / 3
    for i, word in enumerate(words):
        for at in range(n):
            for k in range(1, min(n - at, pieces.longest) + 1):
                place = search(pieces.hashes, np.uint64(pieces._hash(word[at : at + k])))
                held = place < len(pieces.hashes) and int(pieces.hashes[place]) == pieces._hash(word[at : at + k])
                assert found[at, k, i] == (pieces.ids[place] if held else -1)
