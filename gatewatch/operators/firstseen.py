"""First-seen hosts per user over bounded data, and the history of seen pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import duration_seconds
from gatewatch.operators.dedup import first_per_key
from gatewatch.operators.timeline import with_neighbours

PAIR = ["user_id", "computer_id"]
_DAY_MICROS = 86_400_000_000


def first_seen_events(events: DataFrame) -> DataFrame:
    """The first event of every (user, host), by ``(event_time, event_id)``."""
    return first_per_key(
        events.select(*PAIR, "event_time", "event_id"), PAIR, ["event_time", "event_id"]
    )


def last_seen(history: DataFrame) -> Column:
    """When a pair of the history was last seen; histories without that tell the first time."""
    first = F.col("first_seen")
    return F.coalesce(F.col("last_seen"), first) if "last_seen" in history.columns else first


def _events_after_gap(events: DataFrame, ttl: str | int, history: DataFrame | None) -> DataFrame:
    """First event of each pair, and every event that follows a gap longer than ``ttl``.

    The history stands at the head of each pair's timeline, where it was last seen.
    """
    points = events.select(*PAIR, F.unix_micros("event_time").alias("at"), "event_id")
    if history is not None:
        known = history.select(*PAIR, F.unix_micros(last_seen(history)).alias("at"), F.lit(None).cast("string").alias("event_id"))
        points = points.unionByName(known)
    points = points.groupBy(*PAIR, "at").agg(F.min("event_id").alias("event_id"))
    gap = duration_seconds(ttl) * 1_000_000
    near = with_neighbours(points, PAIR, "at", chunk=_DAY_MICROS)
    return near.filter(F.col("event_id").isNotNull() & (F.col("prev").isNull() | (F.col("at") - F.col("prev") > gap)))


def flag_new_devices(
    events: DataFrame, history: DataFrame | None = None, ttl: str | int | None = None
) -> DataFrame:
    """Append ``is_new_device``: the event is the user's first on that host.

    ``history`` holds pairs seen before these events; ``ttl`` forgets a pair that was
    idle for longer. The flagged events are found first, one per pair, and joined back
    by ``event_id``, which is unique after deduplication: unlike a window over each
    pair, no pair's events have to meet in one task.
    """
    if ttl is not None:
        firsts = _events_after_gap(events, ttl, history)
    else:
        firsts = first_seen_events(events)
        if history is not None:
            firsts = firsts.join(history.select(*PAIR), PAIR, "left_anti")
    flagged = firsts.select("event_id", F.lit(True).alias("is_new_device"))
    return events.join(flagged, "event_id", "left").withColumn(
        "is_new_device", F.coalesce("is_new_device", F.lit(False))
    )


def seen_pairs(events: DataFrame) -> DataFrame:
    """History rows: every pair with the times it was first and last seen."""
    return events.groupBy(*PAIR).agg(F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))


def merge_seen_pairs(*histories: DataFrame) -> DataFrame:
    merged = None
    for more in histories:
        rows = more.select(*PAIR, "first_seen", last_seen(more).alias("last_seen"))
        merged = rows if merged is None else merged.unionByName(rows)
    return merged.groupBy(*PAIR).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def new_pairs(events: DataFrame, history: DataFrame) -> DataFrame:
    """Distinct pairs of ``events`` that ``history`` does not hold."""
    return events.select(*PAIR).distinct().join(history.select(*PAIR), PAIR, "left_anti")
