"""Numerals, words of any length, letters of newer Unicode versions, extreme vectors."""

import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from retail_strata.llm import language
from retail_strata.llm import queries as q
from retail_strata.llm.byte_tokens import ByteTokens
from retail_strata.llm.embedding_links import embedding_links
from retail_strata.llm.language import Predictor, pieces_of, predict_languages, train_languages, word_scores, words_of
from retail_strata.llm.word_bpe import word_bpe


@pytest.fixture(scope="module")
def random_model():
    pieces = pieces_of(q.PIECES)
    probability = np.zeros((pieces.size + 1, 3))
    probability[:-1] = np.random.default_rng(0).dirichlet(np.ones(pieces.size), 3).T
    return pieces, probability


def enumerated(word, probability):
    """Every segmentation into pieces, one by one; letters that are no piece as bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=q.PIECES)
    plain = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not model.is_byte(i)}

    def total(rest):
        if not rest:
            return np.ones(probability.shape[1])
        sums = np.zeros(probability.shape[1])
        for k in range(1, len(rest) + 1):
            if rest[:k] in plain:
                sums = sums + probability[plain[rest[:k]]] * total(rest[k:])
        if rest[0] not in plain:
            spelt = [model.piece_to_id(f"<0x{b:02X}>") for b in rest[0].encode()]
            sums = sums + np.prod(probability[spelt], axis=0) * total(rest[1:])
        return sums

    return np.log(total("▁" + word))


@pytest.mark.parametrize("word", ["a", "the", "hello", "straße", "été", "xꙮy"])
def test_forward_sums_are_those_of_all_segmentations(random_model, word):
    pieces, probability = random_model
    assert word_scores(pieces, probability, [word])[word] == pytest.approx(enumerated(word, probability))
    assert language.long_word_score(pieces, probability, word) == pytest.approx(enumerated(word, probability))


def test_words_of_any_length_are_scored_whole(random_model, monkeypatch):
    pieces, probability = random_model
    word = "".join(random.Random(1).choice("abcdeßꙮ") for _ in range(700))
    whole = language.long_word_score(pieces, probability, word)
    monkeypatch.setattr(language, "AT_ONCE", 37)
    assert language.long_word_score(pieces, probability, word) == pytest.approx(whole)
    monkeypatch.setattr(language, "LONG", 1000)
    assert word_scores(pieces, probability, [word])[word] == pytest.approx(whole)


def test_numerals_are_no_letters(spark):
    assert words_of("½ ¼ Ⅳ ① ² x½Y ab12c été_z 東京") == ["x", "y", "ab", "c", "été", "z", "東京"]
    rows = [(0, "½ ¼", None), (2, "Ⅳ ① 12", None), (3, "the house", "en"), (4, "la maison", "fr"), (5, "z" * 500, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in predict_languages(docs, train_languages(docs, q.PIECES)).collect()}
    assert found[0] == found[2] == "und" and found[3] == "en" and found[4] == "fr" and found[5] in ("en", "fr")


def test_long_words_are_not_remembered(random_model):
    from retail_strata.llm.language import LanguageModel

    predictor = Predictor(LanguageModel(["a", "b", "c"], np.zeros(3), random_model[1], q.PIECES))
    first = predictor.scores(["x" * 300 + " short", "x" * 300])
    assert list(predictor.known) == ["short"]
    assert predictor.scores(["x" * 300])[0] == pytest.approx(first[1])


def test_letters_of_other_unicode_versions():
    """A step through all code points; those that were reported as different among them."""
    points = [0x558, 0x88F, 0xC5C, 0x1C89, 0xA7CB, 0x10D50, *range(0x20, 0x323B0, 41)]
    texts = [f"ab{chr(c)}cd 1{chr(c)}2 {chr(c)}" for c in points if not 0xD800 <= c < 0xE000]
    library = Tokenizer.from_file(q.WORD_BPE)
    assert word_bpe(q.WORD_BPE).encode(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_byte_tokens_over_forgetting_and_odd_texts(monkeypatch):
    from retail_strata.llm import byte_tokens

    monkeypatch.setattr(byte_tokens, "MAX_KNOWN", 40)
    monkeypatch.setattr(byte_tokens, "TOGETHER", 300)
    drawn = random.Random(2)
    texts = ["", " ", " a", "a ", "a\nb", "don't 've'll", "x  y", "\x1f", "a\x1cb", "<|endoftext|>", "été ½", "_a_ 12é"]
    texts += [" ".join(drawn.choices(["the", "it's", "Zürich,", "(x)", "12.5", "é", "a\nb", "---"], k=30)) for _ in range(60)]
    tokens, library = ByteTokens(q.BYTE_BPE), Tokenizer.from_file(q.BYTE_BPE)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in tokens.encode(texts)] == expected


def test_extreme_vectors_are_linked(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1e200, 0.0], 1), (3, [1e-200, 0.0], 1), (4, [5e-324, 0.0], 1), (5, [0.0, -1e300], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_links(frame).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


def test_planted_links_near_the_threshold(spark):
    """Copies at cosines around 0.93, chains of them, and exact copies, by brute force."""
    drawn = np.random.default_rng(7)

    def unit(x):
        return x / np.linalg.norm(x)

    vectors = [unit(drawn.normal(size=64)) for _ in range(250)]
    for i in range(0, 200, 2):
        base, other = vectors[i], unit(drawn.normal(size=64))
        other = unit(other - (other @ base) * base)
        cosine = [0.9299, 0.9301, 0.94, 0.98, 1.0][i // 2 % 5]
        vectors.append(cosine * base + np.sqrt(1 - cosine**2) * other)
        if i % 10 == 0:
            vectors.append(unit(vectors[-1] + 0.2 * unit(drawn.normal(size=64))))
    labels = [int(x) for x in drawn.integers(0, 2, size=len(vectors))]
    for i in range(250, len(vectors)):
        labels[i] = 0
    labels[:200:2] = [0] * 100
    matrix = np.array(vectors)
    linked = (matrix @ matrix.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(linked, False)
    component = np.arange(len(vectors))
    while True:
        least = np.minimum(component, np.where(linked, component[None, :], len(vectors)).min(axis=1))
        if (least == component).all():
            break
        component = least
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(vectors, labels))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    out = embedding_links(frame).toPandas().sort_values("vec_id")
    assert linked.sum() > 150
    assert out.n_links.sum() >= 0.9 * linked.sum() and (out.n_links.to_numpy() <= linked.sum(axis=1)).all()
    if out.n_links.sum() == linked.sum():
        assert out.component_id.tolist() == component.tolist()
    else:
        assert (out.component_id.to_numpy() >= component).all()
