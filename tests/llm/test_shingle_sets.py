"""Sets of shingles are sorted and hold each shingle once."""

import numpy as np

from retail_strata.llm.shingles import shingle_sets


def test_repeated_shingles_count_once():
    texts = ["a b c a b c a b", "", "x", "a b " * 500, "b a " * 3]
    sets = shingle_sets(texts, 2)
    assert [len(s) for s in sets] == [3, 0, 1, 2, 2]
    assert all((s[1:] > s[:-1]).all() for s in sets)
    weighed = shingle_sets(texts, 2, weigh=lambda hashes: np.ones(len(hashes), dtype=np.int64))
    assert all((s == w).all() for s, (w, _) in zip(sets, weighed))
