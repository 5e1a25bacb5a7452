"""Window features and their join with events on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.config import HopSpec
from gatewatch.operators.features import FEATURE_COLUMNS
from gatewatch.streaming.slots import closed_windows, features_at_slots, nested


def stream_window(flagged: DataFrame, hop: HopSpec) -> DataFrame:
    """Features of closed windows of any length and slide.

    Streams reject a distinct count. Counting per host first and then hosts per user is
    exact, and no state row ever holds a set of hosts. Each event is copied into all windows
    that hold it; windows that nest are built without copies in ``streaming.slots``.
    """
    span = F.window("event_time", f"{hop.duration} seconds", f"{hop.slide} seconds")
    per_host = (
        flagged.select("event_time", "user_id", "computer_id", "is_new_device", span.alias("w"))
        .groupBy("w", "user_id", "computer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("is_new_device").alias("is_new"))
    )
    return per_host.groupBy("w", "user_id").agg(
        F.count(F.lit(1)).alias("unique_hosts"),
        F.sum("n").alias("event_count"),
        F.max("is_new").alias("has_new_device"),
    )


def stream_features(flagged: DataFrame, hops: list[HopSpec]) -> DataFrame:
    """Rows of the feature table for all given windows, in append mode."""
    if nested(hops):
        windows = closed_windows(flagged, hops)
        end = F.timestamp_micros(F.unix_micros("closes") + 1)
        seconds = F.element_at(F.array(*[F.lit(h.duration) for h in hops]), (F.col("hop") + 1).cast("int")).cast("long")
        label = F.element_at(F.array(*[F.lit(h.label) for h in hops]), (F.col("hop") + 1).cast("int"))
        return windows.withColumns(
            {"window_end": end, "window_start": F.timestamp_micros(F.unix_micros(end) - seconds * F.lit(1_000_000)), "window_size": label}
        ).select(*FEATURE_COLUMNS)
    parts = [
        stream_window(flagged, hop).select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "user_id",
            F.lit(hop.label).alias("window_size"),
            "unique_hosts",
            "event_count",
            "has_new_device",
        )
        for hop in hops
    ]
    features = parts[0]
    for part in parts[1:]:
        features = features.unionByName(part)
    return features.select(*FEATURE_COLUMNS)


def _slot(time: str, hop: HopSpec) -> Column:
    """Number of a time's slot. A plain number: a stream has one event-time column only."""
    return F.floor(F.unix_seconds(time) / F.lit(hop.slide))


def stream_enriched(flagged: DataFrame, hour: HopSpec, day: HopSpec) -> DataFrame:
    """Events with 1h and 24h features, as soon as the windows of their slots close.

    One left join with the features of each user's busy slots. The slots of both lengths are
    part of the key, so a busy user is spread over as many keys as there are busy slots. The
    range on event time says the same once more, in the form that lets Spark bound the
    state of a stream-stream join.
    """
    if not nested([hour, day]) or day.slide < hour.slide:
        raise ValueError("window lengths must be multiples of their slides, and the slides must nest")
    lookup = features_at_slots(flagged, hour, day).withColumn("_closing", _slot("closes", day))
    events = flagged.drop("is_new_device")
    for hop in (hour, day):
        events = events.withColumn(f"_slot_{hop.label}", _slot("event_time", hop))
    condition = (
        (F.col("user_id") == F.col("feature_user"))
        & (F.col(f"_slot_{hour.label}") == F.col("feature_slot"))
        & (F.col(f"_slot_{day.label}") == F.col("_closing"))
        & (F.col("event_time") <= F.col("closes"))
        & (F.col("event_time") > F.col("closes") - F.expr(f"INTERVAL {day.slide} SECONDS"))
    )
    joined = events.join(lookup, condition, "left")
    return joined.drop("closes", "feature_user", "feature_slot", "_closing", f"_slot_{hour.label}", f"_slot_{day.label}")
