"""Quality and language: accuracy on held-out rows, gradients, and texts of all shapes."""

import numpy as np
import pytest

from gatewatch.llm import language, quality
from gatewatch.llm.common import held_out

from .conftest import prose

ALPHABETS = {"aa": "aeioubcd", "bb": "mnoprstu", "cc": "àéèçmnop"}


def junk(n):
    words = prose(n, 40).split()
    return [" ".join(w + "!!" for w in words), " ".join([words[0]] * 40), " | ".join(words)][n % 3]


def quality_rows():
    return [(n, junk(n) if n % 5 == 0 else prose(n, 30 + n % 40)) for n in range(600)]


@pytest.fixture(scope="module")
def quality_model(spark):
    docs = spark.createDataFrame(quality_rows(), "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n % 5 != 0)) for n in range(600)] + [(None, 1), (9000, 0), (7, None)], "doc_id long, quality int")
    return quality.learn(docs, labels)


def test_quality_of_held_out_rows(table, quality_model):
    docs = table(quality_rows())
    scored = quality.score(docs, quality_model).join(docs.select("doc_id", held_out().alias("held")), "doc_id").where("held").collect()
    right = [(r.score >= 0.3) == (r.doc_id % 5 != 0) for r in scored]
    assert len(right) > 60 and np.mean(right) > 0.95


def test_quality_edge_cases(edges, nothing, quality_model, table, spark):
    scores = quality.score(edges, quality_model).collect()
    assert len(scores) == edges.count() and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in scores if r.doc_id in (1, 2, 3)} == {quality_model.bare}
    assert quality.score(nothing, quality_model).count() == 0
    empty = quality.learn(edges, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(edges, empty).collect()} == {0.5}
    one = quality.learn(edges, spark.createDataFrame([(n, 1) for n in range(1, 12)], "doc_id long, quality int"))
    assert all(r.score > 0.9 for r in quality.score(edges, one).collect())


def test_a_slice_has_the_features_of_its_texts():
    texts = ["one two two", "", "xyz", "a bcd a a"]
    raw = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t) for t in texts)])
    together = quality.sparse(np.frombuffer(raw, np.uint8), offsets)
    for text, (ids, shares) in zip(texts, together, strict=True):
        ((own, parts),) = quality.sparse(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == own.tolist() and np.allclose(shares, parts)


def language_rows():
    names = list(ALPHABETS)
    return [(n, prose(n, 1 + n % 60, ALPHABETS[names[n % 3]]), names[n % 3]) for n in range(600)]


@pytest.fixture(scope="module")
def language_model(spark):
    return language.learn(spark.createDataFrame(language_rows() + [(9000, "abc", None), (9001, None, "aa"), (None, "abc", "zz")], "doc_id long, text string, lang string"))


def test_language_of_held_out_rows(table, language_model):
    docs = table(language_rows())
    assert language_model.languages == ["aa", "bb", "cc"]
    got = language.identify(docs, language_model).join(docs.select("doc_id", "lang", held_out().alias("held")), "doc_id").where("held").collect()
    assert len(got) > 60 and np.mean([r.lang == r.lang_pred for r in got]) > 0.93


def test_language_edge_cases(edges, nothing, language_model, table):
    got = {r.doc_id: r for r in language.identify(edges, language_model).collect() if r.doc_id}
    assert all(got[n].lang_pred == "und" and got[n].score == 0 for n in (1, 2, 3, 5))
    assert all(got[n].lang_pred in ALPHABETS and 0 < got[n].score <= 1 for n in (4, 6, 10, 11))
    assert language.identify(edges, language_model).count() == edges.count()
    assert language.identify(nothing, language_model).count() == 0
    assert {r.lang_pred for r in language.identify(edges, language.learn(nothing)).collect()} == {"und"}


def test_segments_cover_every_byte():
    texts = [b"a" * 130, b"", b"bc", b"d" * 64]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    symbols, owners = language.segments(data, offsets, 64)
    for d, text in enumerate(texts):
        own = symbols[owners == d].ravel()
        assert bytes(own[own != language.PAD].tolist()) == text


def test_gradients_of_a_layer():
    rng = np.random.default_rng(2)
    layer = language.Layer(3, rng)
    layer.byte, layer.state = layer.byte.astype(np.float64), layer.state.astype(np.float64)
    x = rng.integers(97, 100, (5, 4))
    wanted = rng.normal(size=(5, 3, 4))

    def loss():
        return float((layer.run(x).astype(np.float64) * wanted).sum())

    kept = []
    layer.run(x, kept)
    of_byte, of_state = layer.back(x, kept, wanted)
    for weights, grads in ((layer.byte, of_byte), (layer.state, of_state)):
        for i, j in zip(*np.nonzero(np.abs(grads) > 0.05), strict=True):
            old = weights[i, j]
            weights[i, j] = old + 1e-2
            up = loss()
            weights[i, j] = old - 1e-2
            down = loss()
            weights[i, j] = old
            assert abs((up - down) / 2e-2 - grads[i, j]) < 0.05 + 0.1 * abs(grads[i, j])
