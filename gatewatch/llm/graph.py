"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import cut


def _both_ways(rows: DataFrame, one: tuple[str, str], other: tuple[str, str]) -> DataFrame:
    """Two edges (``u``, ``v``) for each row, from two pairs of its columns; the rows are gone through once."""
    pairs = (F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in (one, other))
    return rows.select(F.explode(F.array(*pairs)).alias("edge")).select("edge.u", "edge.v")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest reachable id) of every id in ``edges`` (``a``, ``b``); cut.

    Each round hangs the larger neighbours of every node on the smallest (large star) and
    then the smaller ones (small star); after about log2 of the diameter rounds each
    component is one star. All joins have one row per node on one side, so a hub costs as
    many rows as it has edges. Rounds are cut, so none is computed again. The smallest
    neighbours, which a round begins with, also tell whether all are stars and then are the
    result, so no round is run only to find that nothing changes.
    """
    tree = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        sides = [F.count_if(F.col("v") < F.col("u")).alias("below"), F.count_if(F.col("v") > F.col("u")).alias("above")]
        found = _both_ways(tree, ("u", "v"), ("v", "u")).groupBy("u").agg(F.min("v").alias("least"), *sides)
        found = cut(found.select(F.col("u").alias("id"), F.least("u", "least").alias("component"), "below", "above"))
        if found.where("below > 1 or (below > 0 and above > 0)").first() is None:
            return found.select("id", "component")
        large = tree.join(found, F.col("v") == F.col("id")).select("u", F.col("component").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tree = cut(_both_ways(large.join(least, "u"), ("u", "m"), ("v", "m")).where("u <> v").distinct())
