"""Per-event rolling activity: what a user did in the hour or day up to each event."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.operators.firstseen import PAIR

SPANS = {"1h": 3600, "24h": 86400}
_MICROS = 1_000_000


def rolling_activity(events: DataFrame, spans: Mapping[str, int] = SPANS) -> DataFrame:
    """Append ``login_count_<span>`` and ``unique_computers_<span>`` for each span.

    Both ends of ``[event_time - span, event_time]`` count. A range frame with a
    distinct set would hold and rescan each user's whole window for every event; here
    counts are differences of running totals: what came up to the event, less what came
    more than a span before it. A host counts from its first event in a span on, until the
    span has passed its last one.

    The timeline is cut into chunks as long as the longest span, so that a busy user is
    spread over tasks. A chunk also gets the events of the one before it, which is as far
    as its spans reach: with this one copy, of place and host only, all steps work on one
    layout by (user, chunk), two sorts and no join. Without user or time counts are NULL.
    """
    length = max(spans.values()) * _MICROS
    at = F.unix_micros("event_time")
    chunk = F.floor(at / F.lit(length)).cast("long")
    places = F.array(*[F.struct((chunk + n).alias("_chunk"), F.lit(n == 0).alias("_own")) for n in (0, 1)])
    placed = events.select("*", at.alias("_at"), F.explode(places).alias("_place")).select("*", "_place.*")
    carried = [F.when(F.col("_own"), F.col(c)).alias(c) for c in events.columns if c not in (*PAIR, "event_time")]
    laid = placed.select(*PAIR, "_at", "_chunk", "_own", *carried).repartition("user_id", "_chunk")
    along = Window.partitionBy("user_id", "_chunk", "computer_id").orderBy("_at")
    near = laid.withColumns({"_prev": F.lag("_at").over(along), "_next": F.lead("_at").over(along)})

    timeline = Window.partitionBy("user_id", "_chunk").orderBy("_at")
    upto = timeline.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    marks, found = {}, {}
    for label, seconds in spans.items():
        span = seconds * _MICROS
        marks[f"_enters_{label}"] = F.col("_prev").isNull() | (F.col("_at") - F.col("_prev") > span)
        marks[f"_leaves_{label}"] = F.col("_next").isNull() | (F.col("_next") - F.col("_at") > span)
        behind = timeline.rangeBetween(Window.unboundedPreceding, -span - 1)
        found[f"login_count_{label}"] = F.count(F.lit(1)).over(upto) - F.count(F.lit(1)).over(behind)
        present = F.count_if(F.col(f"_enters_{label}")).over(upto) - F.count_if(F.col(f"_leaves_{label}")).over(behind)
        found[f"unique_computers_{label}"] = present
    known = F.col("user_id").isNotNull() & F.col("_at").isNotNull()
    counted = near.withColumns(marks).withColumns(found).filter("_own")
    columns = ["user_id", *[c for c in events.columns if c != "user_id"]]
    # The time came along as a number.
    counted = counted.withColumn("event_time", F.timestamp_micros("_at"))
    return counted.select(*columns, *[F.when(known, F.col(c)).alias(c) for c in found])
