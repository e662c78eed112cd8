"""Lists of frequent shingles, dealt to blocks, against brute force."""

import random

import pytest

from retail_strata.llm import ngram_join as join


@pytest.mark.parametrize("block", [4, 1000])
def test_blocks_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(join, "BLOCK", block)
    monkeypatch.setattr(join, "LONG_LIST", 10**6)  # nothing is put together before
    draw = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"w{draw.randrange(60)}" for _ in range(i % 14)])) for i in range(150)]
    sets = {k: {tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} for k, t in rows}
    root = {k: k for k in sets}

    def top(x):
        return x if root[x] == x else top(root[x])

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in join.ngram_join(docs, words=4, percent=80, rounds=1).collect()}
    assert found == {k: top(k) for k in sets}


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(join, "TOKENS_AT_ONCE", 3)
    draw = random.Random(6)
    left, right = ([{draw.randrange(20) for _ in range(draw.randrange(12))} for _ in range(9)] for _ in "ab")
    packs = [[join.packed(join.np.array(sorted(s), dtype="u8")) for s in side] for side in (left, right)]
    assert join._shared(*packs).tolist() == [[len(a & b) for b in right] for a in left]
