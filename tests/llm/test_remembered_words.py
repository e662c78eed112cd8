"""What the encoder and the block coder work on twice."""

import numpy as np

from retail_strata.llm import byte_tokens, simple8b
from retail_strata.llm import queries as q


def test_words_of_the_latest_texts_stay(monkeypatch):
    monkeypatch.setattr(byte_tokens, "MAX_KNOWN", 4)
    tokens = byte_tokens.ByteTokens(q.BYTE_BPE)
    cut = []
    model = tokens._model
    monkeypatch.setattr(tokens, "_model", lambda new: cut.append(new) or model(new))
    texts = ["one two three, four", "five one six's two", "", "déjà vu"]
    plain = [np.array(tokens.library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert tokens.encode(texts) == plain
    seen = len(cut)
    assert tokens.encode(texts[::-1]) == plain[::-1]
    assert len(cut) == seen  # more words than the bound, and none of them is new
    assert tokens.encode(["seven one"] + texts) == [tokens.encode(["seven one"])[0], *plain]


def test_word_starts_by_walking():
    drawn = np.random.default_rng(8)
    row = simple8b.BLOCK + simple8b.SLACK
    for count in (1, 59, 1023, 1024, 1025, 3000):
        blocks = -(-count // simple8b.BLOCK)
        for selectors in ([0], [1], [14], range(15)):
            selector = drawn.choice(list(selectors), blocks * row).astype(np.int8)
            walked = []
            for block in range(blocks):
                place, end = 0, min(count - block * simple8b.BLOCK, simple8b.BLOCK)
                while place < end:
                    walked.append(block * row + place)
                    place += int(simple8b.PER_WORD[selector[walked[-1]]])
            assert simple8b._word_starts(selector, count, blocks).tolist() == walked
