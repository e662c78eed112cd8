"""Vectors are dealt out once a list and part, and all pairs of a list are still compared."""

import numpy as np
import pytest
from pyspark.sql.group import GroupedData

from retail_strata.llm.embedding_links import BLOCKS_A_PART, embedding_links


@pytest.fixture
def rows_dealt(monkeypatch):
    """How many rows go to groups."""
    apply, dealt = GroupedData.applyInPandas, []

    def counted(self, func, schema):
        dealt.append(self._df.count())
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", counted)
    return dealt


def by_hand(vectors, threshold):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    head = np.arange(len(unit))
    while True:
        least = np.where(linked, head[None, :], len(unit)).min(axis=1)
        if (least == head).all():
            return linked.sum(axis=1) - 1, head
        head = least


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_all_pairs_of_a_long_list(spark, rows_dealt, kind):
    block, n = 16, 1000
    vectors = np.random.default_rng(3).normal(size=(n, 6)).astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], f"vec_id long, embedding {kind}, label int")
    out = embedding_links(frame, pivots=1, nearest=1, shared=1, block=block).toPandas().sort_values("vec_id")
    links, head = by_hand(vectors, 0.93)
    assert links.max() > 3 and len(set(head)) < n - 100
    assert (out["n_links"].to_numpy() == links).all()
    assert (out["component_id"].to_numpy() == head).all()
    assert sum(rows_dealt) <= n * -(-n // (block * BLOCKS_A_PART))


def test_lists_after_which_enough_pivots_are_left(spark, rows_dealt):
    vectors = np.random.default_rng(4).normal(size=(400, 8))
    vectors[200:] = vectors[:200] + 0.02 * np.random.default_rng(5).normal(size=(200, 8))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    out = embedding_links(frame, pivots=16, nearest=6, shared=3).toPandas().sort_values("vec_id")
    links, head = by_hand(vectors, 0.93)
    assert (out["n_links"].to_numpy() <= links).all() and (out["n_links"].to_numpy() > 0).mean() > 0.95
    assert sum(rows_dealt) == 4 * len(vectors)
