"""Words are merged once, and ids and texts are the library's."""

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from retail_strata.llm import queries as q
from retail_strata.llm import word_bpe


def test_words_outlive_the_chunks_they_stood_in(monkeypatch):
    monkeypatch.setattr(word_bpe, "MAX_CACHED", 3)
    bpe, merged = word_bpe.WordBpe(q.WORD_BPE), []
    merge = bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda symbols: merged.append(1) or merge(symbols))
    for texts in (["house, House! (house)"], ["HOUSE? house; house."], ["house house-house"]):
        bpe.encode(texts)
    words = ["house", ",", "!", "(", ")", "?", ";", ".", "-"]
    assert len(merged) == len(words)


def test_word_ids_and_entries_are_the_librarys():
    texts = [
        "", " ", "a\x1cb c", "Σας ΟΔΟΣ", "İstanbul ǅ", "étude Ω K", "q" * 3000 + " " + "é" * 41, "x<|endoftext|>y",
        "it's 12,5 -- (c)", "日本語 текст 😀", "ab͸cd", "\x85a\xa0b\n", "it's 12,5 -- (c)",
    ]
    library, bpe = Tokenizer.from_file(q.WORD_BPE), word_bpe.WordBpe(q.WORD_BPE)
    coded = library.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        flat, starts = bpe.encode_flat(texts)
        ids = pa.ListArray.from_arrays(starts.astype(np.int32), flat)
        assert ids.to_pylist() == [c.ids for c in coded]
        assert word_bpe.decoded(bpe, ids, spaced=True).to_pylist() == [
            library.decode(c.ids, skip_special_tokens=False) for c in coded
        ]
        assert word_bpe.decoded(bpe, ids).to_pylist() == [word_bpe.decode(bpe, c.ids) for c in coded]
