import random
import re
from itertools import combinations

import numpy as np
import pytest

from gatewatch.llm import graph, near_dedup
from gatewatch.llm.common import cut
from gatewatch.llm.graph import components
from gatewatch.llm.near_dedup import estimate, keep_representatives, near_duplicates, registers

from .conftest import prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent):
    parent = {d: d for d, _ in rows if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    sets = [(d, shingles(t)) for d, t in rows]
    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets), key=str)


def found(docs, percent):
    return sorted((tuple(r) for r in near_duplicates(docs, percent).collect()), key=str)


def changed(text, share, seed):
    rng = random.Random(seed)
    return " ".join("zz" + w if rng.random() < share else w for w in text.split())


@pytest.mark.parametrize("percent", [80, 85])
def test_against_all_pairs(table, percent):
    rows = []
    for base in range(12):
        text = prose(base, 30 + 25 * base)
        rows += [(base * 20 + k, changed(text, 0.012 * k, base * 20 + k)) for k in range(12)]
    rows += [(900, "One two THREE"), (901, "one Two three"), (902, "one two"), (903, prose(3, 105).upper())]
    docs = table(rows)
    assert found(docs, percent) == expected(rows, percent)


def test_groups_whose_centre_is_far_from_some(table, monkeypatch):
    """Chains of edits: members of a bucket are linked, though not by its centre; blocks of a few nodes."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    text, rows = prose(77, 160).split(), []
    for k in range(40):
        rows.append((100 - k, " ".join(text)))
        text = text[:]
        text[(k * 4) % 160] = f"new{k}"
    docs = table(rows)
    assert found(docs, 85) == expected(rows, 85)


def test_edge_cases(edges):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(edges, 80) == expected(rows, 80)


def test_empty_table(nothing):
    assert found(nothing, 80) == []
    assert keep_representatives(nothing).count() == 0


def test_representatives_keep_whole_rows(edges):
    kept = keep_representatives(edges)
    assert kept.schema == edges.schema
    ids = [r.doc_id for r in kept.collect()]
    assert 7 not in ids and 8 not in ids and 6 in ids and {1, 2, 3, 4, 5, 10, 11} <= set(ids) and ids.count(None) == 2


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.85):
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            common = int(share * 1000)
            extra = (1000 - common) // 2
            a, b = pool[: common + extra], np.concatenate([pool[:common], pool[common + extra :]])
            agreeing = (registers(a) == registers(b)).sum()
            errors.append(estimate(np.array([agreeing]), np.array([len(a)]), np.array([len(b)]))[0] - share)
        assert abs(np.mean(errors)) < 0.03


def test_components_of_a_chain_a_star_and_a_loop(spark):
    chain = [(n, n + 1) for n in range(1, 60)]
    star = [(100, n) for n in range(101, 180)]
    rows = components(spark.createDataFrame(chain + star + [(200, 200)] + [(201, 202), (202, 201)], "a long, b long")).collect()
    got = {r.id: r.component for r in rows}
    assert all(got[n] == 1 for n in range(1, 61)) and all(got[n] == 100 for n in range(100, 180)) and got[202] == got[201] == 201


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_tasks_however_many_partitions(spark, table, monkeypatch):
    """On small data the files and log entries of tasks take the disk; 2,618 tasks before, 1,803 with fewer exchanges."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    text, rows = prose(77, 160).split(), []
    for k in range(40):
        rows.append((100 - k, " ".join(text)))
        text = text[:]
        text[(k * 4) % 160] = f"new{k}"
    docs, partitions = table(rows), 20
    options = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in options}
    context, group = spark.sparkContext, "test_few_tasks"
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        context.setJobGroup(group, group)
        assert found(docs, 85) == expected(rows, 85)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    ran = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    assert 0 < ran < 110 * partitions


def test_stars_are_told_without_a_round(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(graph, "cut", lambda df: cuts.append(1) or cut(df))
    rows = components(spark.createDataFrame([(1, n) for n in range(2, 9)] + [(20, 21)], "a long, b long")).collect()
    assert {r.id: r.component for r in rows} == {**{n: 1 for n in range(1, 9)}, 20: 20, 21: 20}
    assert len(cuts) == 2
