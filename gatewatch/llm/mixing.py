"""Mixing sources to target weights by Pareto order sampling.

A source whose target is ``f`` times its size takes ``floor(f)`` whole copies of each of
its documents; the rest is a sample of fixed size without replacement. Each document gets
a random odds ``u / (1 - u)`` from a hash of its id, divided by the odds ``p / (1 - p)``
of its inclusion; the documents of lowest quotient are in. Inclusion is unequal: between
sources through their targets, and within a source by the documents' ``favour``.

All is SQL: sums per source, running sums over sources and over bins of the quotient, and
an order of documents only within the one bin of each source in which its sample ends.
The outcome is one row per source, from which each document's copies follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.common import WORD, cut, small_side

#: Bins of the order a source is cut into; only documents of one of them are sorted.
BINS = 1 << 14


def words_in(text: Column | str) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source``, ``source_size`` to ``target``: weights repeat over sources by code point, NULL last.

    All sources together get ``share`` of all sizes. A source gets at most ``most`` times
    its size; what it leaves goes to the others by weight, again and again until none is
    above. In order of ``most * size / weight`` the sources that are full come first, so one
    running sum finds them all.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full_first = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, behind = full_first.rowsBetween(Window.unboundedPreceding, -1), full_first.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("all_sizes", F.sum("source_size").over(Window.partitionBy()))
    )
    # What a unit of weight gets once all sources before this one are full.
    unit = (F.col("all_sizes") * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(behind)
    levels = ranked.withColumn("unit", unit).withColumn("full", F.col("ratio") <= F.col("unit"))
    level = F.min(F.when(~F.col("full"), F.struct("ratio", "unit"))).over(Window.partitionBy())["unit"]
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * level)
    return levels.select("source", "source_size", target.alias("target"))


def _place(chance: Column, seed: int, doc_id: str = "doc_id") -> Column:
    """Where a document stands in the order of its source, in (0, 1).

    ``q = (u / (1 - u)) / (p / (1 - p))`` orders; ``q / (1 + q)`` orders alike and has bounds.
    """
    inside = F.least(F.greatest(chance, F.lit(1e-9)), F.lit(1 - 1e-9))
    draw = F.xxhash64(F.col(doc_id).cast("string"), F.lit(seed)) / F.lit(2.0**64) + 0.5
    draw = F.least(F.greatest(draw, F.lit(1e-12)), F.lit(1 - 1e-12))
    odds = (draw / (1 - draw)) / (inside / (1 - inside))
    return odds / (1 + odds)


def _bin(place: Column) -> Column:
    return F.floor(place * BINS)


def _favour(favour: str | None) -> Column:
    return F.lit(1.0) if favour is None else F.when(F.col(favour) > 0, F.col(favour).cast("double")).otherwise(F.lit(1.0))


def _chance() -> Column:
    """Inclusion in the sampled part: what is still wanted of the source, in proportion to favour."""
    return F.when(F.col("favoured") > 0, F.col("rest") * F.col("favour") / F.col("favoured")).otherwise(F.lit(0.0))


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2,
    seed: int = 9,
    favour: str | None = None,
) -> DataFrame:
    """One row per source: ``mix_source``, ``source_size``, ``target``, certain copies ``whole``, the ``rest`` in words,
    and where its sample ends (``last_bin``, ``last_place``; a NULL bin takes all)."""
    rows = cut(docs.select("doc_id", "source", words_in("text").alias("size"), _favour(favour).alias("favour")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("favour")).alias("favoured"))
    targets = source_targets(sizes.select("source", "source_size"), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goals = targets.join(sizes.select(F.col("source").alias("mix_source"), "favoured"), F.col("source").eqNullSafe(F.col("mix_source")))
    goals = cut(
        goals.withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("mix_source", "source_size", "target", "whole", "rest", "favoured")
    )
    placed = rows.join(small_side(goals, 96), F.col("source").eqNullSafe(F.col("mix_source")))
    placed = placed.withColumn("place", _place(_chance(), seed)).withColumn("bin", _bin(F.col("place")))
    # Running sums over bins find the bin in which the sample ends; only its documents are sorted.
    bins = placed.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"), F.first("rest").alias("rest"))
    upto = F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin"))
    over = bins.withColumn("upto", upto).where("upto > rest").groupBy("source").agg(F.min(F.struct("bin", F.expr("upto - in_bin").alias("before"))).alias("end"))
    ends = cut(over.select(F.col("source").alias("end_source"), "end.bin", "end.before").withColumnRenamed("bin", "end_bin"))
    last = placed.join(small_side(ends, 40), F.col("source").eqNullSafe(F.col("end_source")) & (F.col("bin") == F.col("end_bin")))
    inside = Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("upto", F.sum("size").over(inside) + F.col("before"))
    # The document at which the target is passed is in if that comes nearer.
    passed = F.col("upto") - F.col("rest")
    drawn = (passed <= 0) | ((passed < F.col("size")) & (passed <= F.col("size") - passed))
    ended = last.where(drawn).groupBy("source").agg(F.max("place").alias("last_place")).withColumnRenamed("source", "placed_source")
    return cut(
        goals.join(ends, F.col("mix_source").eqNullSafe(F.col("end_source")), "left")
        .join(ended, F.col("mix_source").eqNullSafe(F.col("placed_source")), "left")
        .select("mix_source", "source_size", "target", "whole", "rest", "favoured", F.col("end_bin").alias("last_bin"), F.coalesce("last_place", F.lit(-1.0)).alias("last_place"))
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2,
    seed: int = 9,
    favour: str | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``) with the copies that the mix takes.

    Returns ``doc`` (the row as a struct, so that no name can clash), ``size`` (words),
    ``source_size``, ``target`` (its source's), ``copies`` and ``taken`` (``copies * size``).
    ``favour`` names a column of positive numbers; within a source, inclusion of the
    sampled part follows it. Without it all documents of a source are alike.

    * Sources end at the document that brings their words nearest to the target.
    * A NULL or empty text has size 0 and no copies; a NULL source is a source of its own.
      Where no source has words, targets are 0.
    * Rows with equal ids (NULL is one) and equal favour stand at one place: all or none are drawn.
    * NULL or non-positive ``favour`` counts as 1. An empty table gives an empty result.

    Texts don't move: what a document gets follows from its own row and its source's row
    of the plan, which is broadcast if small.
    """
    plan = plan_mix(docs, weights, share, most, seed, favour)
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "source", words_in("text").alias("size"), _favour(favour).alias("favour"))
    goals = rows.join(small_side(plan, 128), F.col("source").eqNullSafe(F.col("mix_source")), "left")
    goals = goals.withColumn("place", _place(_chance(), seed)).withColumn("bin", _bin(F.col("place")))
    drawn = F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")) | ((F.col("bin") == F.col("last_bin")) & (F.col("place") <= F.col("last_place")))
    drawn &= F.col("rest") > 0
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("long")).otherwise(F.lit(0)).cast("long")
    return goals.withColumn("copies", copies).select("doc", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
