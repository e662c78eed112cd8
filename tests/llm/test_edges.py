"""Nulls, empty texts and tables, ties, repeated rows and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retail_strata.llm import queries as q
from retail_strata.llm.embedding_links import embedding_links
from retail_strata.llm.simple8b import decode, encode
from retail_strata.llm.word_bpe import decode as decode_ids
from retail_strata.llm.word_bpe import word_bpe

LONG = " ".join(f"word{i} and the other" for i in range(60))
ROWS = [
    (1, None, None, "a", 0), (2, "", "en", "a", 0), (3, " \n ", "en", "b", 3), (4, LONG, "en", "a", 9),
    (4, LONG, "en", "a", 9), (5, LONG + " tail", "en", None, None), (None, "no id, token=abcdefgh12345", "fr", "b", 1),
    (7, "x" * 20_000, "en", "a", 20_000), (8, "12 34 !", None, "a", 7),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = ["key", "node", "label", "n", "body", "start", "shard", "score", "next", "spans", "members"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    made = {}
    for name, rows in (("edge", ROWS), ("empty", [])):
        folder = str(tmp_path_factory.mktemp(name))
        docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})
        docs.write.parquet(f"{folder}/documents.parquet")
        made[name] = folder
    return made


DOCUMENT_QUERIES = [n for n in q.QUERIES if n not in ("op10_embedding_links", "op12_hard_negatives")]


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_edge_rows(spark, folders, name):
    out = q.QUERIES[name](spark, folders["edge"]).toPandas()
    if name not in ("op5_packing", "op8_suffix_dedup"):
        assert len(out) == len(ROWS)
    if name == "op6_ngram_join":
        found = {None if k != k else k: c for k, c in zip(out.doc_id, out.component_id)}
        assert found[5] == found[4] == 4 and found[1] == 1 and found[7] == 7
    if name == "op8_suffix_dedup":
        assert set(out.doc_id) == {4, 5}
        assert sorted(t.strip() for t in out.text) == [LONG, LONG, "tail"] or out.text.str.len().min() < 10


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty_table(spark, folders, name):
    assert q.QUERIES[name](spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("folder", ["edge", "empty"])
def test_pipeline(spark, folders, folder):
    out = corpus_pipeline.run(spark, folders[folder]).toPandas()
    assert set(out.doc_id.dropna()) == ({4, 7} if folder == "edge" else set())


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1), (10, [1.0], 1),
        (11, [None, 1.0], 1), (12, [], 1), (13, [0.0, 1.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    out = {r.vec_id: (r.n_links, r.component_id) for r in embedding_links(frame.withColumn("node", F.lit(0))).collect()}
    assert out[1] == out[2] == out[9] == (2, 1)
    assert all(out[k] == (0, k) for k in (3, 4, 5, 6, 7, 8, 10, 11, 12, 13))
    assert embedding_links(frame.limit(0)).count() == 0


def test_escapes():
    values = [0, 1 << 63, 5, (1 << 60) - 1, 1 << 60, *range(3000)]
    assert decode(encode(values)).tolist() == values


def test_decoder_puts_characters_together():
    bpe = word_bpe(q.WORD_BPE)
    ids = bpe.encode(["Zürich — 東京 <|endoftext|>"])[0]
    assert decode_ids(bpe, ids) == "zürich — 東京 <|endoftext|>"
