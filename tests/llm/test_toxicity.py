import numpy as np
import pytest

from gatewatch.llm import toxicity
from gatewatch.llm.common import held_out

from .conftest import prose

VILE = ["scumbag", "vileword", "hatefuls"]


def rows():
    out = []
    for n in range(400):
        words = prose(n, 20 + n % 30).split()
        if n % 4 == 0:
            words.insert(n % 17, VILE[n // 4 % 3] + "abc"[n % 3])
        out.append((n, " ".join(words)))
    return out


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(n, int(n % 4 == 0)) for n in range(400)] + [(None, 1), (5000, 0), (3, None)], "doc_id long, toxic int")


@pytest.fixture
def model(table, labels):
    return toxicity.learn(table(rows()), labels)


def test_held_out_rows_are_told(table, labels, model):
    docs = table(rows())
    scored = {r.doc_id: (r.score, r.held) for r in toxicity.score(docs, model).join(docs.select("doc_id", held_out().alias("held")), "doc_id").collect()}
    held = [n for n in scored if scored[n][1]]
    assert 40 < len(held) < 120
    assert all((scored[n][0] >= 0.5) == (n % 4 == 0) for n in held)


def test_neighbours_are_the_exact_ones(model):
    index = model.index
    n = len(index.examples)
    dense = np.zeros((n, len(index.weights)))
    for e, (terms, values) in enumerate(index.examples):
        dense[e, terms] = values
    rng = np.random.default_rng(1)
    for _ in range(40):
        terms = np.sort(rng.choice(len(index.weights), 3, replace=False))
        values = index.unit(terms, rng.integers(1, 4, 3).astype(float))
        at, cosines = index.nearest(terms, values, 7)
        every = dense[:, terms] @ values
        order = [e for e in np.lexsort((np.arange(n), -np.round(every, 12))) if every[e] > 0][:7]
        assert at.tolist() == order and np.allclose(cosines, every[order])


def test_no_labels(table, labels):
    docs = table(rows()[:20])
    model = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}


def test_edge_cases(edges, nothing, model):
    scores = toxicity.score(edges, model).collect()
    assert len(scores) == edges.count() and all(0 <= r.score < 0.5 for r in scores)
    kept = toxicity.keep_harmless(edges, model)
    assert kept.schema == edges.schema and kept.count() == edges.count()
    assert toxicity.score(nothing, model).count() == 0 and toxicity.keep_harmless(nothing, model).count() == 0


def test_toxic_rows_go(table, model):
    kept = sorted(r.doc_id for r in toxicity.keep_harmless(table(rows()), model).collect())
    assert kept == [n for n in range(400) if n % 4]
