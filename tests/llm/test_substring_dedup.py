import hashlib
import random
import re
from collections import Counter

import pytest

from gatewatch.llm import substring_dedup
from gatewatch.llm.substring_dedup import COVERS, cover_for, remove_repeats

from .conftest import prose


def expected(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), own in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(own) - window + 1):
            if counts[tuple(own[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def found(docs, window):
    return sorted((tuple(r) for r in remove_repeats(docs, window, texts=True).collect()), key=str)


def passages(seed):
    rng = random.Random(seed)
    shared = [prose(seed * 100 + k, rng.randint(20, 90)).split() for k in range(8)]
    rows = []
    for n in range(60):
        words = prose(seed * 1000 + n, rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            begin, at = rng.randint(0, 15), rng.randint(0, len(words))
            words[at:at] = part[begin : begin + rng.randint(10, 70)]
        rows.append((n, ("\n" if n % 3 else "  ").join(words)))
    return rows + [(100, prose(9, 50)), (101, prose(9, 50)), (102, "same " * 36), (103, "other " * 35), (104, "twice " * 34)]


@pytest.mark.parametrize("window", [35, 20, 5, 1])
def test_against_all_windows(table, window):
    rows = passages(window)
    assert found(table(rows), window) == expected(rows, window)


def test_copies_that_are_too_many_to_broadcast(table, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    rows = passages(4)
    assert found(table(rows), 35) == expected(rows, 35)


def test_edge_cases(edges):
    assert found(edges, 35) == expected([(r.doc_id, r.text) for r in edges.collect()], 35)


def test_empty_table(nothing):
    assert found(nothing, 35) == []


def test_covers_have_every_difference():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert cover_for(35)[0] == 21 and cover_for(1) == (1, (0,))
