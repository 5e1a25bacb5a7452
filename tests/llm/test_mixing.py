from collections import defaultdict

from pyspark.sql import functions as F

from gatewatch.llm.mixing import mix, plan_mix

from .conftest import prose


def rows_of(docs, **options):
    return mix(docs, **options).select("doc.doc_id", "doc.source", "size", "source_size", "target", "copies", "taken").collect()


def water_filled(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_sources = {}, share * sum(sizes.values()), set(names)
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if unit * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_sources}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_sources -= full
    return target


def test_targets_and_words_taken(table):
    docs = table([(n, prose(n, 1 + n % 40), None, ["a", "b", "b", "c", "d", None][n % 6]) for n in range(3000)])
    rows = rows_of(docs)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = water_filled(sizes)
    for source in sizes:
        assert abs(target[source] - want[source]) < 1e-6 * max(want[source], 1)
        assert abs(taken[source] - target[source]) <= 20
        assert all(r.source_size == sizes[source] for r in rows if r.source == source)
    assert sorted(map(str, rows)) == sorted(map(str, rows_of(docs.repartition(7))))


def test_favoured_documents_are_in_more_often(table):
    docs = table([(n, prose(n, 5), None, "s") for n in range(2000)]).withColumn("liked", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    rows = rows_of(docs, share=0.3, favour="liked")
    even = sum(r.copies for r in rows if r.doc_id % 2 == 0)
    odd = sum(r.copies for r in rows if r.doc_id % 2 == 1)
    assert 2 < even / odd < 4.5 and abs(sum(r.taken for r in rows) - 3000) <= 5


def test_edge_cases(edges):
    rows = rows_of(edges)
    assert len(rows) == edges.count()
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert {r.copies for r in rows if r.size == 0} == {0}
    assert len({(r.size, r.copies) for r in rows if r.doc_id == 9 and r.size == 60}) == 1


def test_texts_without_words(table):
    rows = rows_of(table([(1, None, None, "a"), (2, "", None, None)]))
    assert [(r.size, r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 2


def test_empty_table(nothing):
    assert rows_of(nothing) == [] and plan_mix(nothing).count() == 0


def test_no_python_in_the_plan(table):
    plan = mix(table([(n, "a b", None, "s") for n in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
