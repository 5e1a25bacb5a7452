import hashlib
from collections import defaultdict

import numpy as np
import pytest

from gatewatch.llm.exact_dedup import LEAST, MOST, chunk_ends, dedup_exact, keep_first_copies, recipes, settled

from .conftest import prose


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((doc_id, keep, len(groups[text or ""]), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in dedup_exact(docs, **options).collect()), key=str)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_edge_cases(edges):
    assert found(edges) == expected(pairs(edges))


def test_empty_table(nothing):
    assert found(nothing) == []


@pytest.mark.parametrize("digest_bytes", [0, 1])
def test_equal_keys_of_unlike_chunks_are_told_apart(table, digest_bytes):
    docs = table([(n, prose(n % 30, 80 + n % 2)) for n in range(90)])
    assert found(docs, digest_bytes=digest_bytes) == expected(pairs(docs))


def test_same_chunks_in_another_order_differ(table):
    one, two = prose(4, 2000), prose(5, 2000)
    docs = table([(1, one + two), (2, two + one), (3, one + two)])
    assert {r.doc_id: r.keep_id for r in dedup_exact(docs).collect()} == {1: 3, 2: 2, 3: 3}


def test_chunks_cover_texts_and_follow_content():
    text = np.frombuffer(prose(6, 30_000).encode(), np.uint8)
    ends = chunk_ends(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= MOST and sizes[:-1].min() >= LEAST
    shifted = chunk_ends(text[1000:])
    assert len({e - 1000 for e in ends} & set(shifted)) > len(ends) * 0.9


def test_chunks_without_a_cut_end_at_the_most():
    assert chunk_ends(np.zeros(2 * MOST + 5, np.uint8))[-1] == 2 * MOST + 5


def test_very_long_texts_move_one_list_each(table):
    """Two long texts that differ in a character and a copy of each: what moves grows as the texts do."""
    moved = []
    for megabytes in (2, 4):
        text = (prose(7, 40_000) * 40)[: megabytes << 20]
        docs = table([(1, text), (2, text[:-1] + "#"), (3, text), (4, text[:-1] + "#"), (5, "short")])
        rows = dedup_exact(docs).collect()
        assert {r.doc_id: (r.keep_id, r.group_size) for r in rows} == {1: (3, 2), 2: (4, 2), 3: (3, 2), 4: (4, 2), 5: (5, 1)}
        shared = settled(recipes(docs.select("doc_id", "text"))).selectExpr("size(recipe) as n").collect()
        assert len(shared) == 2
        moved.append(sum(r.n for r in shared))
    assert moved[1] < 2.2 * moved[0]


def test_first_copies_keep_whole_rows(edges):
    kept = keep_first_copies(edges)
    assert kept.schema == edges.schema
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in pairs(edges)})
    assert {r.doc_id for r in kept.collect() if r.text and r.text.endswith("end")} == {8}


def test_first_copies_of_nothing(nothing):
    assert keep_first_copies(nothing).count() == 0
