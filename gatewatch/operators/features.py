"""Sliding and tumbling window features per user.

Plain hop windows copy every event into each of the 12 or 24 windows it belongs to and
count distinct hosts in every copy. Here events are first counted per (user, host, slot),
a slot being one slide. A host then enters a user's window at one slot and leaves it at
another, so two change rows per counted row are enough, and the features are running
totals of the changes. Rows shuffled do not depend on how much windows overlap, and no
distinct count is left. A user's timeline has at most two points per slot, however many
events the user has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.config import DAY_HOP, HOUR_HOP, HopSpec
from gatewatch.functions.times import slot, slot_start
from gatewatch.operators.firstseen import PAIR
from gatewatch.operators.timeline import running_totals, with_neighbours

FEATURE_COLUMNS = [
    "window_start",
    "window_end",
    "user_id",
    "window_size",
    "unique_hosts",
    "event_count",
    "has_new_device",
]


def _pair_slots(events: DataFrame, width: int, history: DataFrame | None = None) -> DataFrame:
    """Events counted per user, host and slot, with the pair's adjacent slots.

    ``is_new`` tells whether the pair is first seen in the slot. It is taken from an
    ``is_new_device`` column when the events have one.
    """
    flagged = "is_new_device" in events.columns
    counts = [F.count(F.lit(1)).alias("n")]
    if flagged:
        counts.append(F.bool_or(F.coalesce("is_new_device", F.lit(False))).alias("is_new"))
    slots = events.groupBy(*PAIR, slot("event_time", width).alias("slot")).agg(*counts)
    if flagged:
        return with_neighbours(slots, PAIR, "slot")
    if history is None:
        return with_neighbours(slots, PAIR, "slot").withColumn("is_new", F.col("prev").isNull())
    # Joined before the pairs are laid out for their neighbours: a bucketed history then
    # decides the layout of both steps and stays where it is.
    known = history.select(*PAIR, F.lit(True).alias("_known"))
    return (
        with_neighbours(slots.join(known, PAIR, "left"), PAIR, "slot")
        .withColumn("is_new", F.col("prev").isNull() & F.col("_known").isNull())
        .drop("_known")
    )


def _coarse(position: Column, ratio: int) -> Column:
    return position if ratio == 1 else F.floor(position / F.lit(ratio)).cast("long")


def _presence(ratio: int, steps: int) -> tuple[Column, Column, Column]:
    """``(slot, enters, leaves)`` of a pair row for windows of ``steps`` coarse slots.

    Enters is 1 where the host was in none of the preceding ``steps`` slots, leaves is 1
    where it is in none of the following ones.
    """
    here, before, after = (_coarse(F.col(c), ratio) for c in ("slot", "prev", "next"))
    enters = before.isNull() | (here - before >= steps)
    leaves = after.isNull() | (after - here >= steps)
    return here, enters.cast("long"), leaves.cast("long")


def _hop_changes(hop: HopSpec, width: int) -> list[Column]:
    here, enters, leaves = _presence(hop.slide // width, hop.steps)
    new = F.col("is_new").cast("long")

    def change(at, sign, hosts):
        return F.struct(
            F.lit(hop.label).alias("window_size"),
            at.alias("slot"),
            (F.col("n") * sign).alias("event_count"),
            (hosts * sign).alias("unique_hosts"),
            (new * sign).alias("new_hosts"),
        )

    return [change(here, 1, enters), change(here + hop.steps, -1, leaves)]


def _by_label(hops: list[HopSpec], value) -> Column:
    chosen = F
    for hop in hops:
        chosen = chosen.when(F.col("window_size") == hop.label, F.lit(value(hop)))
    return chosen


def laid_by_day(hops: list[HopSpec]) -> bool:
    """Whether the steps of all windows can be cut at the ends of days."""
    return all(h.aligned and h.steps > 1 and 86400 % h.slide == 0 for h in hops)


def _aligned_features(events: DataFrame, hops: list[HopSpec], history: DataFrame | None, by_day: bool = False) -> DataFrame:
    width = min(hop.slide for hop in hops)
    changes = [c for hop in hops for c in _hop_changes(hop, width)]
    deltas = _pair_slots(events, width, history).select("user_id", F.inline(F.array(*changes)))
    steps = running_totals(
        deltas, ["user_id", "window_size"], "slot", ["event_count", "unique_hosts", "new_hosts"]
    )
    slide = _by_label(hops, lambda hop: hop.slide)
    reach = _by_label(hops, lambda hop: hop.steps - 1)
    steps = steps.filter(F.col("event_count") > 0).withColumn("last", F.col("next") - 1)
    if by_day:
        steps = _cut_by_day(steps, _by_label(hops, lambda hop: 86400 // hop.slide), reach)
    # A step with events in it is never longer than one window, so this stays small.
    windows = steps.withColumn("slot", F.explode(F.sequence("slot", "last")))
    return windows.select(
        F.timestamp_seconds((F.col("slot") - reach) * slide).alias("window_start"),
        F.timestamp_seconds((F.col("slot") + 1) * slide).alias("window_end"),
        "user_id",
        "window_size",
        "unique_hosts",
        "event_count",
        (F.col("new_hosts") > 0).alias("has_new_device"),
    )


def _cut_by_day(steps: DataFrame, per_day: Column, reach: Column) -> DataFrame:
    """Steps cut where their windows begin on another day, and dealt by that day and the window size.

    A step stands for several windows, so a table of windows is laid out for its partitions
    before there are that many rows.
    """
    first, last = (F.floor((F.col(c) - reach) / per_day).cast("long") for c in ("slot", "last"))
    cut = steps.withColumn("_day", F.explode(F.sequence(first, last)))
    begins = F.col("_day") * per_day + reach
    cut = cut.withColumns({"slot": F.greatest("slot", begins), "last": F.least("last", begins + per_day - 1)})
    return cut.hint("rebalance", "_day", "window_size")


def _tumbling_features(events: DataFrame, hop: HopSpec, history: DataFrame | None) -> DataFrame:
    rows = _pair_slots(events, hop.slide, history)
    return (
        rows.groupBy("user_id", "slot")
        .agg(
            F.count(F.lit(1)).alias("unique_hosts"),
            F.sum("n").alias("event_count"),
            F.bool_or("is_new").alias("has_new_device"),
        )
        .select(
            slot_start(F.col("slot"), hop.slide).alias("window_start"),
            slot_start(F.col("slot") + 1, hop.slide).alias("window_end"),
            "user_id",
            F.lit(hop.label).alias("window_size"),
            "unique_hosts",
            "event_count",
            "has_new_device",
        )
    )


def _general_features(events: DataFrame, hop: HopSpec) -> DataFrame:
    """Windows whose length is no multiple of the slide; needs ``is_new_device``."""
    span = F.window("event_time", f"{hop.duration} seconds", f"{hop.slide} seconds")
    return (
        events.groupBy(span.alias("w"), "user_id")
        .agg(
            F.countDistinct("computer_id").alias("unique_hosts"),
            F.count(F.lit(1)).alias("event_count"),
            F.bool_or("is_new_device").alias("has_new_device"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "user_id",
            F.lit(hop.label).alias("window_size"),
            "unique_hosts",
            "event_count",
            "has_new_device",
        )
    )


def window_features(
    events: DataFrame, hops: list[HopSpec], history: DataFrame | None = None, by_day: bool = False
) -> DataFrame:
    """One row per user and window that holds at least one of the user's events.

    ``by_day`` deals rows out by the day they begin on and their size, where ``laid_by_day`` allows it.
    """
    by_day = by_day and laid_by_day(hops)
    tumbling = [h for h in hops if h.steps == 1 and h.aligned]
    sliding = [h for h in hops if h.steps > 1 and h.aligned]
    general = [h for h in hops if not h.aligned]
    parts = [_tumbling_features(events, h, history) for h in tumbling]
    if sliding:
        finest = min(h.slide for h in sliding)
        nested = [h for h in sliding if h.slide % finest == 0]
        parts.append(_aligned_features(events, nested, history, by_day))
        parts += [_aligned_features(events, [h], history, by_day) for h in sliding if h not in nested]
    if general:
        if "is_new_device" not in events.columns:
            raise ValueError("windows that are no multiple of their slide need is_new_device")
        parts += [_general_features(events, h) for h in general]
    features = parts[0]
    for part in parts[1:]:
        features = features.unionByName(part)
    return features.select(*FEATURE_COLUMNS)


def compute_rolling_windows(
    df: DataFrame,
    *,
    window_1h_duration: str = "1 hour",
    window_1h_slide: str = "5 minutes",
    window_24h_duration: str = "24 hours",
    window_24h_slide: str = "1 hour",
    use_hop_windows: bool = True,
) -> DataFrame:
    """1h and 24h features in one table, told apart by ``window_size``."""
    hour = HopSpec.of("1h", window_1h_duration, window_1h_slide if use_hop_windows else None)
    day = HopSpec.of("24h", window_24h_duration, window_24h_slide if use_hop_windows else None)
    return window_features(df, [hour, day])


def features_at_events(
    events: DataFrame, hour: HopSpec = HOUR_HOP, day: HopSpec = DAY_HOP, history: DataFrame | None = None
) -> DataFrame:
    """Per user and slot with events: the features of the windows that end with the slot.

    Those are, for every event of the slot, the earliest-ending windows that hold it.
    Computed for both window lengths in one pass, without building any other window.
    """
    if not (hour.aligned and day.aligned) or day.slide % hour.slide:
        raise ValueError("window lengths must be multiples of their slides, and the slides must nest")
    ratio = day.slide // hour.slide
    here, enters, leaves = _presence(1, hour.steps)
    day_slot, day_enters, day_leaves = _presence(ratio, day.steps)
    # Within a coarse slot only the pair's first row may enter and its last may leave.
    opens = F.col("prev").isNull() | (_coarse(F.col("prev"), ratio) < day_slot)
    closes = F.col("next").isNull() | (_coarse(F.col("next"), ratio) > day_slot)
    new = F.col("is_new").cast("long")
    zero = F.lit(0).cast("long")

    def change(at, events_1h, hosts_1h, new_1h, hosts_24h, occupied):
        return F.struct(
            at.alias("slot"),
            events_1h.alias("event_count"),
            hosts_1h.alias("unique_hosts"),
            new_1h.alias("new_hosts"),
            hosts_24h.alias("day_hosts"),
            occupied.alias("occupied"),
        )

    # All four rows are written out and empty ones filtered, which keeps this generated
    # code; filtering the array itself would not.
    one = F.lit(1).cast("long")
    changes = F.array(
        change(here, F.col("n"), enters, new, zero, one),
        change(here + hour.steps, -F.col("n"), -leaves, -new, zero, zero),
        change(F.when(opens & (day_enters == 1), day_slot * ratio), zero, zero, zero, one, zero),
        change(F.when(closes & (day_leaves == 1), (day_slot + day.steps) * ratio), zero, zero, zero, -one, zero),
    )
    values = ["event_count", "unique_hosts", "new_hosts", "day_hosts"]
    points = (
        _pair_slots(events, hour.slide, history)
        .select("user_id", F.inline(changes))
        .filter(F.col("slot").isNotNull())
        .groupBy("user_id", "slot")
        .agg(*[F.sum(v).alias(v) for v in values], F.max("occupied").alias("occupied"))
    )
    upto = Window.partitionBy("user_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        points.select("user_id", "slot", "occupied", *[F.sum(v).over(upto).alias(v) for v in values])
        .filter(F.col("occupied") == 1)
        .select(
            "user_id",
            "slot",
            F.col("event_count").alias("window_1h_event_count"),
            F.col("unique_hosts").alias("window_1h_unique_hosts"),
            F.col("day_hosts").alias("window_24h_unique_hosts"),
            (F.col("new_hosts") > 0).alias("has_new_device"),
        )
    )
