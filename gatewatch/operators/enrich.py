"""Joins of events with window features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import DAY_HOP, HOUR_HOP, HopSpec
from gatewatch.functions.times import slot, slot_start
from gatewatch.operators.features import features_at_events


def join_slots(events: DataFrame, lookup: DataFrame, hour: HopSpec = HOUR_HOP) -> DataFrame:
    """Append the features that ``features_at_events`` computed for each event's slot.

    One equi-join on (user, slot) takes the place of two range joins and a self-join:
    the slot of an event names the window, and a busy user is spread over slots.
    """
    missing = {
        "window_1h_event_count": F.lit(0),
        "window_1h_unique_hosts": F.lit(0),
        "window_24h_unique_hosts": F.lit(0),
        "has_new_device": F.lit(False),
    }
    return (
        events.withColumn("slot", slot("event_time", hour.slide))
        .join(lookup, ["user_id", "slot"], "left")
        .drop("slot")
        .withColumns({name: F.coalesce(F.col(name), absent) for name, absent in missing.items()})
    )


def attach_features(
    events: DataFrame, hour: HopSpec = HOUR_HOP, day: HopSpec = DAY_HOP, history: DataFrame | None = None
) -> DataFrame:
    """Append the 1h and 24h features of the earliest-ending windows that hold each event."""
    return join_slots(events, features_at_events(events, hour, day, history), hour)


def attach_window_features(events: DataFrame, features: DataFrame, hop: HopSpec) -> DataFrame:
    """The same for one window length, reading an existing feature table.

    Appends ``window_<label>_event_count``, ``window_<label>_unique_hosts`` and
    ``window_<label>_has_new_device``; 0 and false where the table has no window.
    """
    if not hop.aligned:
        raise ValueError("window length must be a multiple of its slide")
    prefix = f"window_{hop.label}"
    names = {c: f"{prefix}_{c}" for c in ("event_count", "unique_hosts", "has_new_device")}
    side = features.filter(F.col("window_size") == hop.label).select(
        "user_id", F.col("window_end").alias("_end"), *[F.col(c).alias(n) for c, n in names.items()]
    )
    missing = {"event_count": F.lit(0), "unique_hosts": F.lit(0), "has_new_device": F.lit(False)}
    return (
        events.withColumn("_end", slot_start(slot("event_time", hop.slide) + 1, hop.slide))
        .join(side, ["user_id", "_end"], "left")
        .drop("_end")
        .withColumns({n: F.coalesce(F.col(n), missing[c]) for c, n in names.items()})
    )


def behavior_context(
    alerts: DataFrame, features: DataFrame, label: str = "1h", limit: int = 50
) -> DataFrame:
    """Top rows of events joined with every window of the same user.

    The report is sorted by ``risk_score`` and cut at ``limit``. Each event gives at
    least one row, so its rows all come from the first ``limit`` events in that order:
    those are picked before the join, which keeps it from pairing all events of a user
    with all of the user's windows.
    """
    order = [F.desc("risk_score"), F.desc("event_time"), F.asc("user_id"), F.asc("dst_host")]
    top = alerts.orderBy(*order).limit(limit)
    side = features.filter(F.col("window_size") == label).select(
        "user_id",
        "window_start",
        F.col("unique_hosts").alias("unique_hosts_1h"),
        F.col("event_count").alias("event_count_1h"),
        F.col("has_new_device").alias("has_new_device"),
    )
    # ``top`` has at most ``limit`` rows, which bounds the broadcast.
    users = F.broadcast(top.select("user_id").distinct())
    return (
        top.select("user_id", "event_time", "dst_host", "risk_score", "risk_flags")
        .join(side.join(users, "user_id", "left_semi"), "user_id", "left")
        .orderBy(*order, F.asc_nulls_first("window_start"))
        .limit(limit)
    )
