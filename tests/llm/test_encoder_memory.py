"""What the byte encoder holds, and what it takes for plain text."""

import tracemalloc

import numpy as np
import pyarrow as pa

from retail_strata.llm import byte_tokens
from retail_strata.llm import queries as q


def test_remembered_words_are_no_python_objects():
    tokens = byte_tokens.ByteTokens(q.BYTE_BPE)
    texts = [" ".join(f"w{chr(97 + i % 26)}{i}x" for i in range(first, first + 1000)) for first in range(0, 60_000, 1000)]
    tokens.encode(texts[:1])
    tracemalloc.start()
    try:
        before = pa.total_allocated_bytes()
        tokens.encode(texts)
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert held < 6_000_000  # 100 bytes a word; strings in dictionaries took more than twice that


def test_arrow_texts_of_every_plain_letter_and_pair_of_white_spaces():
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(0x260)]
    texts += [f"a{x}{y}b" for x in spaces for y in spaces + "<|é"] + [x + y for x in spaces for y in spaces]
    tokens = byte_tokens.ByteTokens(q.BYTE_BPE)
    expected = [e.ids for e in tokens.library.encode_batch(texts, add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        found = tokens.encode(pa.array(texts, type=kind), np.array([7], dtype="<u4").tobytes())
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [[*ids, 7] for ids in expected]
