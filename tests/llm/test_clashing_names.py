"""Operators themselves, on tables whose further columns have the names they use inside."""

import pytest
from pyspark.sql import functions as F

from retail_strata.llm import queries as q
from retail_strata.llm.alignment import align_tokenizers
from retail_strata.llm.embedding_links import embedding_links
from retail_strata.llm.language import predict_languages, train_languages
from retail_strata.llm.mixing import mix
from retail_strata.llm.ngram_join import ngram_join
from retail_strata.llm.packing import pack
from retail_strata.llm.secrets import find_secrets, redact, train_secrets
from retail_strata.llm.suffix_dedup import deduplicated
from retail_strata.llm.token_counts import count_tokens
from retail_strata.llm.word_bpe import encode_decode

PASSAGE = " ".join(f"word{i}" for i in range(60))
NAMES = [
    "body", "_id", "_other", "_body", "passages", "repeats", "removed", "assign", "access", "hex", "spans", "_row",
    "_text", "_runs", "_fixed", "_cuts", "key", "node", "row", "size", "print", "members", "share", "n_tokens", "ids", "n",
    "a", "b", "doc", "none", "first", "last", "cut", "component", "shingle", "start", "taken", "_c0", "_c1", "lang_pred",
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [
        (1, "one " + PASSAGE, "en", "a"), (2, "two " + PASSAGE + " end", "en", "a"), (3, None, None, None),
        (4, "token=abcdefgh12345 and the rest", "en", "b"),
    ]
    folder = str(tmp_path_factory.mktemp("clash")) + "/docs"
    made = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    made.withColumns({c: F.lit(f"own {c}") for c in NAMES}).write.parquet(folder)
    return spark.read.parquet(folder)


def kept(row, but=()):
    return all(row[c] == f"own {c}" for c in NAMES if c not in but)


def test_passages_are_cut_and_columns_stay(docs):
    out = {r.doc_id: r for r in deduplicated(docs).collect()}
    assert set(out) == {1, 2, 3, 4} and out[1].text == "one " + PASSAGE and out[2].text.split() == ["two", "end"]
    assert out[1].removed == "" and out[1].repeats and out[4].repeats is None
    assert all(kept(r, but=("repeats", "removed")) for r in out.values())


def test_secrets_are_found_and_marked_and_columns_stay(docs):
    model = train_secrets(docs)
    clean = redact(docs, model)
    assert clean.columns == docs.columns
    out = {r.doc_id: r for r in clean.collect()}
    assert "[SECRET] and the rest" in out[4].text and "abcdefgh" not in out[4].text
    assert out[3].text is None and all(map(kept, out.values()))
    found = {r.doc_id: r for r in find_secrets(docs, model).collect()}
    assert len(found[4].assign) == 1 and "abcdefgh12345" in found[4].assign[0].value and len(found[4].spans) >= 1
    assert all(kept(r, but=("assign", "access", "hex", "spans")) for r in found.values())


def test_the_others_take_what_they_need(docs, spark):
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, q.BYTE_BPE).collect()}[3] == 0
    assert pack(docs, q.BYTE_BPE).select("doc_id").distinct().count() == 4
    assert ngram_join(docs, words=4, percent=85).count() == 4
    assert encode_decode(docs, q.WORD_BPE).count() == 4
    assert align_tokenizers(docs, q.BYTE_BPE, q.PIECES).count() == 4
    assert {r.doc_id: r.taken >= 0 for r in mix(docs).collect()} == {1: True, 2: True, 3: True, 4: True}
    model = train_languages(docs, q.PIECES)
    assert {r.doc_id: r.lang_pred for r in predict_languages(docs, model).collect()}[3] == "und"
    vectors = spark.range(3).selectExpr("id AS vec_id", "1 AS label", "array(1.0D, double(id)) AS embedding")
    assert embedding_links(vectors.withColumns({c: F.lit("x") for c in NAMES})).count() == 3
