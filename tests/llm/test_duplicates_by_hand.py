"""Joins and repeats against brute force over the whole small tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from retail_strata.llm import queries as q
from tests.llm.test_queries_by_hand import FOLDER, docs, result  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def test_ngram_components(spark, docs):  # noqa: F811
    sets = {}
    for key, text in zip(docs.doc_id, docs.text):
        w = words(text)
        sets[key] = frozenset(tuple(w[i : i + 4]) for i in range(max(len(w) - 3, min(len(w), 1))))
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for key, own in sets.items():
        shared = Counter(other for s in own for other in lists[s])
        for other, n in shared.items():
            if 100 * n >= 85 * (len(own) + len(sets[other]) - n):
                a, b = root(key), root(other)
                parent[max(a, b)] = min(a, b)
        for s in own:
            lists[s].append(key)
    out = result(spark, "op6_ngram_join").set_index("doc_id")
    assert out.n_shingles.to_dict() == {k: len(s) for k, s in sets.items()}
    assert out.component_id.to_dict() == {k: root(k) for k in sets}


def test_repeats(spark, docs):  # noqa: F811
    holders, grams = defaultdict(set), {}
    for key, text in zip(docs.doc_id, docs.text):
        w = words(text)
        grams[key] = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        for g in grams[key]:
            holders[g].add(key)
    out = result(spark, "op8_suffix_dedup").set_index("doc_id")
    assert set(out.index) == {k for k, own in grams.items() if any(len(holders[g]) > 1 for g in own)}
    before = sum(len(h) > 1 for h in holders.values())
    left = defaultdict(set)
    for key, text in zip(docs.doc_id, docs.text):
        w = words(out.text.get(key, text))
        for i in range(len(w) - 49):
            left[tuple(w[i : i + 50])].add(key)
    assert sum(len(h) > 1 for h in left.values()) <= 0.001 * before


def test_embedding_links(spark):
    table = pd.read_parquet(f"{FOLDER}/embeddings.parquet").sort_values("vec_id")
    unit = np.array(table.embedding.tolist(), dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (table.label.to_numpy()[:, None] == table.label.to_numpy()[None, :])
    out = q.QUERIES["op10_embedding_links"](spark, FOLDER).toPandas().sort_values("vec_id")
    true = linked.sum(axis=1) - 1
    assert (out.n_links.to_numpy() <= true).all()
    assert out.n_links.sum() >= 0.9 * true.sum()
    assert (out.kept == (out.vec_id == out.component_id)).all()
