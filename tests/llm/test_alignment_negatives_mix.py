"""Alignment, hard negatives and source mix against plain Python, and their edge rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retail_strata.llm import hard_negatives as hn
from retail_strata.llm import queries as q
from retail_strata.llm.alignment import align_tokenizers, components
from retail_strata.llm.hard_negatives import hard_negatives
from retail_strata.llm.mixing import mix, mixed_classes, mixture, settle
from retail_strata.llm.token_counts import byte_symbols

FOLDER = "/root/testdata/sf0.01"


# Alignment.


def aligned_by_hand(texts):
    """Cuts, links and counts as the contract words them, token by token."""
    library = Tokenizer.from_file(q.BYTE_BPE)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=q.PIECES)
    byte_of = byte_symbols()

    def piece_bytes(i):
        piece = pieces.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    tokens = []
    for text in texts:
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        a = [(i, bytes(byte_of[c] for c in library.id_to_token(i))) for i in a]
        b = [(i, piece_bytes(i)) for i in b]
        whole = (" " + (text or "")).encode()
        fits = text and all(b"".join(x for _, x in side) == whole for side in (a, b))
        sides = []
        for side in (a, b) if fits else ([], []):
            end, ends = 0, []
            for i, x in side:
                end += len(x)
                ends.append((i, end))
            sides.append(ends)
        tokens.append(sides)
    counts, links = Counter(), []
    for a, b in tokens:
        at = {end: i for i, end in a}
        links.append([(at[end], i) for i, end in b if end in at])
        counts.update(links[-1])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for (a, b), linked in zip(tokens, links):
        shared, parts = sorted({e for _, e in a} & {e for _, e in b}), []
        for start, end in zip([0, *shared], shared):
            parts.append("|".join(",".join(str(i) for i, e in side if start < e <= end) for side in (a, b)))
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""
        best = sum(counts[p] == most[p[1]] for p in linked)
        rows.append((len(a), len(b), len(parts), len(linked), best, sum(counts[p] for p in linked), digest))
    return rows


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "a", " a  b ", "\n\n a\tb\r\n", "<|endoftext|> and <s>x</s> <0x41>", "▁a b", "é ﬁ ½ 東京 🙂", "é \u0000 x",
    "x" * 3000, "word " * 400, "no break  two", "a b", "a b", "ends with space ", "﻿mark ​", "'s 't it's 'S",
]


@pytest.mark.parametrize("heavy", [1, 40, 131_072])
def test_alignment_of_odd_texts(spark, heavy):
    rows = [(i if i != 3 else None, t, "x", "y") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, n_a string")
    out = align_tokenizers(docs, q.BYTE_BPE, q.PIECES, heavy).toPandas()
    found = {-1 if pd.isna(r.doc_id) else int(r.doc_id): tuple(getattr(r, n) for n in NAMES) for r in out.itertuples()}
    expected = dict(zip([i if i != 3 else -1 for i in range(len(ODD))], aligned_by_hand(ODD)))
    assert found == expected
    assert align_tokenizers(docs.limit(0), q.BYTE_BPE, q.PIECES).count() == 0


def test_alignment_query(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet").sort_values("doc_id")
    out = q.QUERIES["op11_tokenizer_alignment"](spark, FOLDER).toPandas().sort_values("doc_id")
    assert out.doc_id.tolist() == docs.doc_id.tolist()
    assert list(map(tuple, out[NAMES].values.tolist())) == aligned_by_hand(docs.text.tolist())


def test_every_token_points_to_the_end_of_its_component():
    drawn = random.Random(5)
    for _ in range(200):
        length = drawn.randint(1, 60)
        ends = [np.array(sorted({*drawn.sample(range(1, length + 1), drawn.randint(0, length)), length})) for _ in "ab"]
        label_a, label_b = components(*ends)
        shared = np.intersect1d(*ends)
        for own, label in zip(ends, (label_a, label_b)):
            group = np.searchsorted(shared, own, "left")
            assert (np.searchsorted(ends[1], shared[group], "left") + len(ends[0]) == label).all()


# Hard negatives.


def mined_by_hand(rows, positives=5, negatives=3, low=50, high=95):
    """``rows``: (vec_id, label, vector, anchor)."""
    def order(found):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))

    rows = [r for r in rows if r[1] is not None and r[2] and None not in r[2]]
    out = []
    for at, (anchor, label, vector, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        same, others = [], []
        for i, (other, its, w, _) in enumerate(rows):
            if i != at and len(w) == len(vector):
                (same if its == label else others).append((sum(x * y for x, y in zip(vector, w)), other))
        for score, positive in order(same)[:positives]:
            window = [x for x in order(others) if low * score <= 100 * x[0] <= high * score]
            out += [(anchor, positive, k, n, score, s) for k, (s, n) in enumerate(window[:negatives], 1)]
    return Counter(out)


MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, label string, vector array<bigint>, anchor boolean")
    frame = frame.withColumns({"node": F.lit("x"), "score": F.lit("y"), "length": F.lit(None).cast("string")})
    return Counter(map(tuple, hard_negatives(frame).select(*MINED).collect()))


@pytest.mark.parametrize("bucket_rows", [8, 4096])
def test_negatives_of_clustered_rows(spark, monkeypatch, bucket_rows):
    """Tight groups, where the coordinate ranges cut, ties, and rows of very different length."""
    monkeypatch.setattr(hn, "BUCKET_ROWS", bucket_rows)
    drawn = np.random.default_rng(3)
    centres = drawn.normal(size=(12, 8))
    rows = []
    for i in range(600):
        scale = 10.0 ** drawn.integers(0, 4)
        vector = np.floor(scale * (centres[i % 12] + 0.05 * drawn.normal(size=8))).astype(int).tolist()
        rows.append((i, str(drawn.integers(0, 3)), vector, i % 25 == 0))
    rows += [(600 + i, "0", rows[5][2], i == 3) for i in range(8)]
    assert mined(spark, rows) == mined_by_hand(rows) != Counter()


def test_negatives_of_edge_rows(spark):
    rows = [
        (1, "a", [3, 4], True), (2, "a", [3, 4], None), (2, "a", [3, 4], False), (None, "a", [5, 5], True),
        (4, "b", [2, 3], False), (None, "b", [2, 3], False), (5, "b", [2, 3], True), (6, None, [2, 3], True),
        (7, "b", None, True), (8, "b", [], True), (9, "b", [None, 1], True), (10, "b", [2], True),
        (11, "b", [0, 0], True), (12, "a", [-3, -4], True), (13, "c", [-2, -3], False), (14, "c", [1 << 28, 1], False),
    ]
    assert mined(spark, rows) == mined_by_hand(rows) != Counter()
    assert mined(spark, [(1, "a", [1 << 30, 0], True), (2, "a", [1, 1], True)]) == Counter()
    assert mined(spark, []) == Counter()


def test_negatives_query(spark):
    out = q.QUERIES["op12_hard_negatives"](spark, FOLDER).select(*MINED).collect()
    with duckdb.connect() as db:
        db.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
        expected = db.sql(q.ORACLES["op12_hard_negatives"]).project(", ".join(MINED)).fetchall()
    assert Counter(map(tuple, out)) == Counter(expected) != Counter()


# Mix.


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    """The excess of one round after another is shared by weight until none is above."""
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    total, full = sum(sizes.values()), set()
    target = {s: total * weight[s] / sum(weight.values()) for s in sizes}
    while over := [s for s in sizes if s not in full and target[s] > most * sizes[s] + 1e-9]:
        excess = sum(target[s] - most * sizes[s] for s in over)
        full.update(over)
        target |= {s: float(most * sizes[s]) for s in over}
        free = [s for s in sizes if s not in full]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[t] for t in free)
    return target


def check_mix(out, docs):
    words = docs.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    source = docs.source.map(lambda s: None if pd.isna(s) else s)
    sizes = {}
    for s, n in zip(source, words):
        sizes[s] = sizes.get(s, 0) + n
    target = targets_by_hand(sizes)
    named = out.source.map(lambda s: None if pd.isna(s) else s)
    assert sorted(out["size"]) == sorted(words) and out.source_size.tolist() == [sizes[s] for s in named]
    assert out.target.tolist() == pytest.approx([target[s] for s in named])
    assert ((out["size"] == 0) | (out.taken % out["size"].clip(lower=1) == 0)).all()
    assert (out.taken <= 3 * out["size"]).all() and (out.taken >= 0).all()
    for s, wanted in target.items():
        rows = out[[x == s for x in named]]
        assert abs(rows.taken.sum() - wanted) <= rows["size"].max()
        rate = wanted / sizes[s] if sizes[s] else 0
        assert rows[rows["size"] > 0].copies.isin([int(rate), int(rate) + 1]).all()


def test_mix_query(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    out = q.QUERIES["op13_source_mix"](spark, FOLDER).toPandas()
    check_mix(out, docs)
    again = q.QUERIES["op13_source_mix"](spark, FOLDER).toPandas()
    assert sorted(map(tuple, out.values.tolist())) == sorted(map(tuple, again.values.tolist()))


def test_mix_of_edge_rows_over_several_buckets_and_layouts(spark):
    drawn = random.Random(1)
    rows = [(i, "w " * drawn.randint(0, 30), "hot", "x", 1) for i in range(700)]
    rows += [(None, "same words here", "hot", "x", 2)] * 300 + [(7, "a b", None, "x", 3)] * 5
    rows += [(8, None, "b", "x", 4), (9, "", "", "x", 5), (10, " \n", "zero", None, 6), (11, "one two", "É", "x", 7)]
    rows += [(20 + i, "long " * 900, "z" * 3, "x", 8) for i in range(3)]
    schema = "doc_id bigint, text string, source string, size string, members int"
    docs = spark.createDataFrame(rows, schema)
    out = mix(docs, bucket_classes=4).toPandas()
    check_mix(out, pd.DataFrame(rows, columns=["doc_id", "text", "source", "size", "members"]))
    other = mix(docs.repartition(5, "text").orderBy("text"), bucket_classes=4).toPandas()
    plain = [sorted(map(str, x[["doc_id", "source", "size", "taken"]].values.tolist())) for x in (out, other)]
    assert plain[0] == plain[1]
    # The mix itself has every text as often as its copies say.
    copies = Counter()
    for r in out.itertuples():
        copies[(r.source, r.size)] += r.copies
    real = Counter()
    for r in mixture(docs, bucket_classes=4).collect():
        real[(r.source, len((r.text or "").split()))] += 1
    assert real == +copies
    assert mix(docs.limit(0)).count() == mixture(docs.limit(0)).count() == 0


def test_rounding_keeps_words_and_averages():
    sizes, shares = np.array([50, 7, 7, 0, 3, 1, 90]), np.array([0.3, 0.5, 0.9, 0.5, 0.2, 0.7, 0.4])
    drawn, sums = np.random.default_rng(0), np.zeros(len(sizes))
    for _ in range(4000):
        settled = settle(sizes, shares, drawn.random(len(sizes)))
        assert settled @ sizes == pytest.approx(shares @ sizes)
        assert ((settled > 0) & (settled < 1)).sum() <= 1
        sums += settled
    assert sums / 4000 == pytest.approx(shares, abs=0.04)


def test_mix_spreads_a_class_with_very_many_members(spark, monkeypatch):
    from retail_strata.llm import mixing

    monkeypatch.setattr(mixing, "CHUNK", 8)
    docs = spark.range(100).selectExpr("1L AS doc_id", "'a b' AS text", "if(id < 60, 'p', 'q') AS source")
    out = mix(docs).toPandas()
    assert len(out) == 100 and out.groupby("source").taken.sum().to_dict() == {
        s: pytest.approx(t, abs=2) for s, t in targets_by_hand({"p": 120, "q": 80}).items()
    }
    assert mixed_classes(docs).count() == 2
