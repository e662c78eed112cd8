"""What goes into token files is worked on once."""

import numpy as np

from retail_strata.llm import byte_tokens, simple8b
from retail_strata.llm import queries as q


def test_pre_tokens_are_seen_once_by_the_model(monkeypatch):
    """Also by texts further apart than a million characters, within one batch."""
    tokens = byte_tokens.ByteTokens(q.BYTE_BPE)
    seen = []
    model = tokens._model
    monkeypatch.setattr(tokens, "_model", lambda cut: seen.append(len(cut)) or model(cut))
    tokens.encode(["house " * 100_000] * 4)
    assert len(seen) == 2  # words behind a space, and the first ones


def test_selectors_by_trying_every_width():
    drawn = np.random.default_rng(4)
    for most in (1, 9, 16, 40, 63):
        values = drawn.integers(0, 1 << 63, 3000, dtype=np.uint64) >> (63 - drawn.integers(0, most + 1, 3000)).astype(np.uint64)
        large = values > simple8b.DATA
        flat = np.concatenate([np.where(large, 0, values), np.zeros(simple8b.SLACK, dtype=np.uint64)])
        large = np.concatenate([large, np.zeros(simple8b.SLACK, dtype=bool)])
        chosen = simple8b._selectors(flat, large)
        for at in range(0, 3000, 7):
            fit = [
                s for s in range(1, len(simple8b.PER_WORD))
                if not large[(run := slice(at, at + int(simple8b.PER_WORD[s])))].any()
                and int(flat[run].max()).bit_length() <= simple8b.WIDTH_OF[s]
            ]
            assert chosen[at] == min(fit, default=0)
        assert (simple8b.decode(simple8b.encode(values)) == values).all()
