"""Sketches rule pairs out before their sets are read, and never a link."""

import random

from retail_strata.llm import ngram_join as join


def test_sketches_never_differ_by_more_than_the_sets():
    draw = random.Random(3)
    for _ in range(300):
        common = {draw.randrange(1 << 48) for _ in range(draw.choice([0, 3, 60, 500]))}
        left, right = ({draw.randrange(1 << 48) for _ in range(draw.choice([1, 5, 70, 300]))} | common for _ in "ab")
        sketches = [join._sketch(join.np.array(sorted(s), dtype="u8")) for s in (left, right)]
        assert join._differing(*sketches) == join._differing(*sketches[::-1]) <= len(left ^ right)
        assert join._differing(sketches[0], sketches[0]) == 0
    assert join._differing(*[join._sketch(join.np.arange(a, a + 400, dtype="u8")) for a in (0, 100)]) == 200


def test_sets_of_pairs_far_apart_are_not_read(spark, monkeypatch):
    """A quarter of their rarest shingles in common makes them meet, not alike."""
    read = []
    sets = join._sets

    def counted(docs, classes, nodes, words):
        read.append(nodes.count())
        return sets(docs, classes, nodes, words)

    monkeypatch.setattr(join, "_sets", counted)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, f"{passage} " + " ".join(f"w{k}x{i}" for i in range(40))) for k in range(40)]
    rows += [(100, rows[7][1] + " more"), (101, None), (None, rows[9][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.component_id) for r in join.ngram_join(docs, words=4, percent=85).collect()}
    assert found == {(k, k) for k in range(40)} | {(100, 7), (101, 101), (None, 9)}
    assert sum(read) == 2
