"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Toxic documents go, then all but one of equal texts, all but one of each group of near
copies, and what holds benchmark items; the rest is mixed to source weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from gatewatch.llm.common import scratch_table, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``copies`` (how many times each), ``taken`` words and their source's ``target``.

    These take the place of columns of the same names.
    """
    own = ("copies", "taken", "target")
    columns = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in own]
    return mixing.mix(docs).where("copies > 0").select(*columns, *own)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", harmless),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Several stages (scores, sketches, tiles) have no SQL form; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return docs
