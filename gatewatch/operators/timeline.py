"""Running totals and neighbours along a key's timeline.

Both can cut each timeline into chunks of fixed length, so that one key with very many
points is worked on by as many tasks as its timeline has chunks. Across chunks only one
small row per key and chunk is passed on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_chunk"


def _chunk(pos: str, length: int):
    return F.floor(F.col(pos) / F.lit(length)).cast("long").alias(_CHUNK)


def with_neighbours(points: DataFrame, keys: Sequence[str], pos: str, chunk: int | None = None) -> DataFrame:
    """Append ``prev`` and ``next``: the key's adjacent positions, NULL at the ends.

    Positions must be distinct per key.
    """
    if chunk is None:
        order = Window.partitionBy(*keys).orderBy(pos)
        return points.withColumns({"prev": F.lag(pos).over(order), "next": F.lead(pos).over(order)})

    chunked = points.withColumn(_CHUNK, _chunk(pos, chunk))
    along = Window.partitionBy(*keys).orderBy(_CHUNK)
    edges = (
        chunked.groupBy(*keys, _CHUNK)
        .agg(F.min(pos).alias("_low"), F.max(pos).alias("_high"))
        .select(
            *keys, _CHUNK, F.lag("_high").over(along).alias("_before"), F.lead("_low").over(along).alias("_after")
        )
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(pos)
    return (
        chunked.join(edges, [*keys, _CHUNK])
        .withColumns(
            {
                "prev": F.coalesce(F.lag(pos).over(inside), F.col("_before")),
                "next": F.coalesce(F.lead(pos).over(inside), F.col("_after")),
            }
        )
        .drop(_CHUNK, "_before", "_after")
    )


def running_totals(
    deltas: DataFrame, keys: Sequence[str], pos: str, values: Sequence[str], chunk: int | None = None
) -> DataFrame:
    """Sum ``values`` per key and position, then total them up along the positions.

    The result is a step function: a row holds from its position up to the next one,
    which is appended as ``next`` when the timeline is not chunked.
    """
    points = deltas.groupBy(*keys, pos).agg(*[F.sum(v).alias(v) for v in values])
    if chunk is None:
        order = Window.partitionBy(*keys).orderBy(pos)
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = [F.sum(v).over(upto).alias(v) for v in values]
        return points.select(*keys, pos, *totals, F.lead(pos).over(order).alias("next"))

    chunked = points.withColumn(_CHUNK, _chunk(pos, chunk))
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunked.groupBy(*keys, _CHUNK)
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(*keys, _CHUNK, *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}") for v in values])
    )
    inside = (
        Window.partitionBy(*keys, _CHUNK).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return chunked.join(carried, [*keys, _CHUNK]).select(
        *keys, pos, *[(F.sum(v).over(inside) + F.col(f"_{v}")).alias(v) for v in values]
    )
