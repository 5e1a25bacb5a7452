"""The pipeline's result on a small corpus against what each stage must do, and its stages on odd inputs."""

import pytest

import corpus_pipeline

from .conftest import prose

VILE = ["scumbag", "vileword", "hatefuls"]


@pytest.fixture
def corpus(table, spark, folder):
    rows = []
    for n in range(200):
        words = prose(n, 60 + n % 20).split()
        if n % 4 == 0:
            words.insert(5, VILE[n // 4 % 3])
        rows.append((n, " ".join(words), "en", f"s{n % 3}"))
    clean = prose(901, 80)
    rows += [(1000, clean, "en", "s0"), (1001, clean, "en", "s1"), (1002, clean + " more", "en", "s2"), (1003, prose(902, 50) + " " + prose(903, 40), "en", "s0")]
    docs = table(rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(n, 1, int(n % 4 == 0)) for n in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(903, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages_take_effect(spark, corpus, folder):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert all(n % 4 for n in out if n < 200)
    assert {n for n in out if n >= 1000} <= {1001}
    candidates = {n for n in range(200) if n % 4} | {1001}
    assert set(out) <= candidates and len(out) > len(candidates) // 2
    assert {r.copies for r in out.values()} <= {1, 2}


def test_stages_keep_columns_and_bear_anything(spark, corpus, folder, edges, nothing):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0
        kept = stage(spark, edges, folder)
        assert kept.count() > 0
        if name != "mixing":
            assert kept.columns == edges.columns
