import random

import numpy as np
import pytest

from gatewatch.llm.decontamination import contaminations, decontaminate, keep_clean, tile
from gatewatch.llm.words import mix

from .conftest import prose


def greedy(document, item, least):
    """Tiles by trying all pairs of places at every length."""
    used_d, used_i, covered = set(), set(), 0
    for size in range(min(len(document), len(item)), least - 1, -1):
        for i in range(len(item) - size + 1):
            for d in range(len(document) - size + 1):
                free = not used_d & set(range(d, d + size)) and not used_i & set(range(i, i + size))
                if free and document[d : d + size] == item[i : i + size]:
                    used_d |= set(range(d, d + size))
                    used_i |= set(range(i, i + size))
                    covered += size
    return covered


def test_tiles_against_all_pairs():
    rng = random.Random(8)
    for _ in range(60):
        document = [rng.randint(1, 3) for _ in range(rng.randint(0, 30))]
        item = [rng.randint(1, 3) for _ in range(rng.randint(1, 20))]
        tiles = tile(mix(np.array(document, np.uint64)), mix(np.array(item, np.uint64)), 2)
        assert sum(t[2] for t in tiles) == greedy(document, item, 2)
        assert all(document[d : d + n] == item[i : i + n] for d, i, n in tiles)


@pytest.fixture
def benchmark(spark):
    rows = [("1", prose(1, 40)), ("2", prose(2, 30)), ("3", "Short one here"), ("4", None), ("5", ""), ("2", prose(2, 30)), (None, prose(8, 20))]
    return spark.createDataFrame(rows, "item_id string, text string")


def documents():
    one, two = prose(1, 40).split(), prose(2, 30).split()
    return [
        (1, prose(50, 200) + " " + " ".join(one) + " " + prose(51, 90)),
        (2, " ".join(one[20:]) + ". " + prose(52, 30) + ", " + " ".join(one[:20]).upper()),
        (3, " ".join(one[:20]) + " " + prose(53, 50)),
        (4, " ".join(w + "!" for w in two)),
        (5, "It is a SHORT, one here?"),
        (6, prose(54, 300)),
        (7, " ".join(one) + " " + " ".join(two)),
        (8, " ".join(w for k, w in enumerate(two) if k % 4)),
    ]


@pytest.mark.parametrize("block_bytes", [8 << 20, 150])
def test_reordered_passages_are_found(table, benchmark, block_bytes):
    rows = {r.doc_id: (r.contaminated, r.items) for r in decontaminate(table(documents()), benchmark, block_bytes=block_bytes).collect()}
    assert rows == {
        1: (True, ["1"]), 2: (True, ["1"]), 3: (False, []), 4: (True, ["2"]), 5: (True, ["3"]), 6: (False, []), 7: (True, ["1", "2"]), 8: (False, []),
    }


def test_spans_are_bytes_of_the_text(table, benchmark):
    text = "é " + prose(2, 30) + "."
    (hit,) = contaminations(table([(1, text)]), benchmark.where("item_id = '2'").limit(1)).collect()
    (span,) = hit.byte_spans
    assert text.encode()[span[0] : span[1]].decode() == prose(2, 30) and hit.coverage == 1


@pytest.mark.parametrize("block_bytes", [8 << 20, 150])
def test_clean_documents_stay_whole(table, benchmark, block_bytes):
    docs = table(documents())
    kept = keep_clean(docs, benchmark, block_bytes=block_bytes)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [3, 6, 8]


def test_edge_cases(edges, nothing, benchmark, spark):
    # Three texts begin with item 1 and three with item 2.
    assert keep_clean(edges, benchmark).count() == edges.count() - 6
    hits = {r.doc_id: r.items for r in decontaminate(edges, benchmark).where("contaminated").collect()}
    assert hits == {6: ["1"], 7: ["1"], 8: ["1"], 9: ["2"], None: ["2"]}
    assert decontaminate(nothing, benchmark).count() == 0 and keep_clean(nothing, benchmark).count() == 0
    empty = benchmark.limit(0)
    assert keep_clean(edges, empty).count() == edges.count() and decontaminate(edges, empty).where("contaminated").count() == 0
