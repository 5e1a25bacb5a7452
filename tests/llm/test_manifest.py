import hashlib
import zlib

import pytest

from gatewatch.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars):
    values = [row["doc_id"], row["source"], row["lang"], n_chars, row["text"]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    found = [leaves]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def beside(tree, at):
    path = []
    for below in tree[:-1]:
        other = at ^ 1
        path.append((below[other] if other < len(below) else "", other < at))
        at //= 2
    return path


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["n_chars"])))
    own = {lang: levels([leaf(r, r["n_chars"]) for r in trees[lang]]) for lang in langs}
    over = levels([own[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            path = beside(own[lang], i) + beside(over, n)
            changed = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf(r, r["n_chars"] + 1) if changed else own[lang][0][i]
            for other, left in path:
                folded = h(other, folded) if left else h(folded, other)
            out.append((r["doc_id"], own[lang][0][i], own[lang][-1][0], over[-1][0], h(*(p for p, _ in path)), folded, folded == over[-1][0]))
    return sorted(out, key=str)


def proofs(df):
    return sorted(map(tuple, manifest.digest(manifest.prove(df)).collect()), key=str)


@pytest.mark.parametrize("band", [2, 12])
def test_trees_of_all_sizes(table, monkeypatch, band):
    monkeypatch.setattr(manifest, "BAND", band)
    sizes = {"a": 1, "b": 2, "c": 3, "é": 5, "z": 8, "\U0001f600": 17, None: 9}
    rows, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((n * 13 % 101, f"text {n}", lang, "s"))
            n += 1
    df = table(rows)
    got = proofs(df)
    assert got == brute(df.collect())
    assert {r[6] for r in got} == {True, False}


def test_edges(edges):
    assert proofs(edges) == brute(edges.collect())


def test_one_row(table):
    df = table([(3, "x", "en", "s")])
    ((_, own, subroot, root, _, _, verified),) = proofs(df)
    assert own == subroot == root and verified


def test_nothing(nothing):
    assert proofs(nothing) == []


def test_siblings_are_what_the_parent_has_besides():
    block = manifest.Block.over([str(i) for i in range(5)], 3)
    assert [s.tolist() for s in block.starts] == [[0, 1, 2, 3, 4, 5], [0, 2, 4, 5], [0, 4, 5], [0, 5]]
    assert block.siblings(4) == [("", False), ("", False), (block.hashes[2][0], True)]
    assert block.siblings(2) == [("3", False), (block.hashes[1][0], True), (block.hashes[2][1], False)]


def test_heights(spark):
    sizes = [1, 2, 3, 4, 5, 8, 9, 1 << 40, (1 << 40) + 1]
    got = spark.createDataFrame([(s,) for s in sizes], "size long").select(manifest.height(spark_col())).collect()
    assert [r[0] for r in got] == [(s - 1).bit_length() for s in sizes]


def spark_col():
    from pyspark.sql import functions as F

    return F.col("size")
