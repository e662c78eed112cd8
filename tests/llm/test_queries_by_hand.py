"""The registered queries against plain Python over the same whole table."""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from retail_strata.llm import queries as q

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{FOLDER}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def result(spark, name):
    return q.QUERIES[name](spark, FOLDER).toPandas()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    """Leftmost matches of the fixed patterns, short ones dropped afterwards."""
    found = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for rank, (kind, pattern, group, least) in enumerate(
        [("assign", assign, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    ):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m.group(group)) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def test_secrets(spark, docs):
    out = result(spark, "op1_secret_scan").set_index("doc_id")
    assert len(out) == len(docs)
    planted = 0
    for key, text in zip(docs.doc_id, docs.text):
        found = base_spans(text or "")
        planted += len(found)
        row = out.loc[key]
        named = [f"{kind}:{start}:{end}" for start, _, end, kind in found]
        assert row.base_sha256 == sha(",".join(named))
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(f[3] == kind for f in found) for kind in ("assign", "access", "hex")
        ]
        assert set(named) <= set(row.spans.split(","))
    assert planted > 0


def encoded(docs, name, end=()):
    library = Tokenizer.from_file(name)
    return [e.ids + list(end) for e in library.encode_batch(docs.text.fillna("").tolist(), add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_counts(spark, docs):
    out = result(spark, "op2_token_counts").sort_values("doc_id")
    ids = encoded(docs, q.BYTE_BPE)
    assert out.n_tokens.tolist() == [len(i) for i in ids]
    assert out.n_bytes.tolist() == [len((t or "").encode()) for t in docs.text]
    assert out.over_limit.tolist() == [len(i) > 1024 for i in ids]


def test_token_files(spark, docs):
    out = result(spark, "op3_token_files").sort_values("doc_id")
    ids = encoded(docs, q.BYTE_BPE, [0])
    lengths = [len(i) for i in ids]
    assert out.n_tokens.tolist() == lengths
    assert out.start.tolist() == [0, *np.cumsum(lengths)[:-1].tolist()]
    assert out.ids_crc32.tolist() == [crc(i) for i in ids]


def test_languages(spark, docs):
    out = result(spark, "op4_language_id").merge(docs, on="doc_id")
    assert out.held_out.tolist() == [zlib.crc32(str(k).encode()) % 5 == 0 for k in out.doc_id]
    judged = out[out.held_out & out.lang.notna()]
    assert len(judged) > 20 and (judged.lang_pred == judged.lang).mean() > 0.95
    assert out.score.between(0, 1).all()


def test_packing(spark, docs):
    out = result(spark, "op5_packing")
    ids = dict(zip(docs.doc_id, encoded(docs, q.BYTE_BPE, [0])))
    for key, pieces in out.sort_values("start").groupby("doc_id"):
        own = ids.pop(key)
        assert pieces.start.tolist() == [0, *pieces.length.cumsum()[:-1].tolist()]
        assert pieces.length.sum() == len(own) and (pieces.doc_tokens == len(own)).all()
        assert [crc(own[s : s + n]) for s, n in zip(pieces.start, pieces.length)] == pieces.ids_crc32.tolist()
    assert not ids
    padding = total = 0
    for _, window in out.sort_values("offset").groupby("sequence_id"):
        assert window.offset.tolist() == [0, *window.length.cumsum()[:-1].tolist()]
        filled = window.length.sum()
        assert filled <= 1024
        total += filled
        padding += 0 if filled & (filled - 1) == 0 else 1024 - filled
    assert padding <= 0.01 * total


def test_word_bpe(spark, docs):
    out = result(spark, "op9_word_bpe").sort_values("doc_id")
    library = Tokenizer.from_file(q.WORD_BPE)
    ids = encoded(docs, q.WORD_BPE)
    assert out.n_tokens.tolist() == [len(i) for i in ids]
    assert out.ids_sha256.tolist() == [sha(" ".join(map(str, i))) for i in ids]
    assert out.decoded_sha256.tolist() == [sha(library.decode(i, skip_special_tokens=False)) for i in ids]


def signatures(text, anchors):
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    found = set()
    for at, word in enumerate(words):
        rest = [w for w in words[at + 1 :] if w not in anchors][:2]
        if word in anchors and len(rest) == 2:
            found.add((word, *rest))
    return found or set(words)


def test_spot_signatures(spark, docs):
    out = result(spark, "op7_spot_signatures").set_index("doc_id")
    anchors = set(q.common_words(q.table(spark, FOLDER, "documents")))
    texts = docs.text.fillna("").tolist()
    previous = [texts[-1], *texts[:-1]]
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    by_text = {}
    for key, text, after in zip(docs.doc_id, texts, previous):
        row, cut = out.loc[key], len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert row.n_chars == len(text) and row.edited_sha256 == sha(edited)
        own = signatures(text, anchors)
        assert len(row.fingerprint) == 12 * len(own)
        assert row.near_edited == pytest.approx(jaccard(own, signatures(edited, anchors)))
        assert row.near_next == pytest.approx(jaccard(own, signatures(after, anchors)))
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
