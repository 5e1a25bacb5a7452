"""Build plans: from events to features, curated and wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.config import PipelineConfig
from gatewatch.functions.risk import apply_risk_engine, fired_flags, indicator_score, risk_level
from gatewatch.functions.times import event_date
from gatewatch.operators.dedup import deduplicate
from gatewatch.operators.enrich import join_slots
from gatewatch.operators.features import features_at_events, window_features
from gatewatch.operators.firstseen import flag_new_devices
from gatewatch.operators.rolling import rolling_activity
from gatewatch.operators.rollups import flag_rare_hosts
from gatewatch.sources.validate import canonical_events, scoring_view, with_event_id

CURATED_COLUMNS = [
    "event_time",
    "user_id",
    "src_host",
    "dst_host",
    "success",
    "window_1h_event_count",
    "window_1h_unique_hosts",
    "window_24h_unique_hosts",
    "has_new_device",
    "risk_score",
    "risk_flags",
    "event_date",
]


def clean_events(events: DataFrame, unique: bool = False) -> DataFrame:
    """Canonical events, one per id. ``unique`` says the input is deduplicated already.

    An event without id gets one from its time, user and host, so none is lost.
    """
    events = canonical_events(events)
    return events if unique else deduplicate(with_event_id(events))


def mark_expiring(events: DataFrame, cfg: PipelineConfig, history: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """With a TTL, events with their first-seen marks, and no history left to look at.

    A stream forgets pairs that were idle for longer than its ``state_ttl``; builds from
    its events have to as well. Without a TTL features find first-seen events by themselves.
    """
    if cfg.stream.state_ttl is None:
        return events, history
    return flag_new_devices(events, history, cfg.stream.state_ttl), None


def build_raw(events: DataFrame, unique: bool = False) -> DataFrame:
    """Rows of the raw table."""
    return clean_events(events, unique).select(
        "event_time", "user_id", "computer_id", "event_id", event_date().alias("event_date")
    )


def build_features(
    events: DataFrame,
    cfg: PipelineConfig | None = None,
    history: DataFrame | None = None,
    unique: bool = False,
    by_day: bool = False,
) -> DataFrame:
    """Rows of the feature table: both window lengths; ``by_day`` as in ``window_features``."""
    cfg = cfg or PipelineConfig()
    events, history = mark_expiring(clean_events(events, unique), cfg, history)
    return window_features(events, [cfg.hour_hop, cfg.day_hop], history, by_day)


def build_curated(
    events: DataFrame,
    cfg: PipelineConfig | None = None,
    history: DataFrame | None = None,
    unique: bool = False,
    keep_event_id: bool = False,
) -> DataFrame:
    """Rows of the curated table: events with window features, score and flags."""
    cfg = cfg or PipelineConfig()
    events = clean_events(events, unique)
    if cfg.risk.rare_host_mode == "popularity":
        events = flag_rare_hosts(events)
    events, history = mark_expiring(events, cfg, history)
    # Scoring reads the view of the events, the features the events themselves.
    lookup = features_at_events(events, cfg.hour_hop, cfg.day_hop, history)
    enriched = join_slots(scoring_view(events), lookup, cfg.hour_hop)
    curated = apply_risk_engine(enriched, cfg.risk).withColumn("event_date", event_date())
    return curated.select(*CURATED_COLUMNS, *(["event_id"] if keep_event_id else []))


def build_wide(
    events: DataFrame,
    cfg: PipelineConfig | None = None,
    history: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Events with rolling counts, 0/1 indicators, and their score, flags and level."""
    cfg = cfg or PipelineConfig()
    events = clean_events(events, unique)
    # Flags come first, so that what finds them reads the events and not the rolling counts.
    marked = flag_rare_hosts(flag_new_devices(events, history, cfg.stream.state_ttl))
    rolled = rolling_activity(marked)
    flags = ["is_new_device", "is_rare_host"]
    first = ["computer_id", "event_id", "user_id"]
    flagged = rolled.select(*first, *[c for c in rolled.columns if c not in (*first, *flags)], *flags)
    risk = cfg.risk
    indicators = {
        "is_new_device": F.col("is_new_device"),
        "is_burst_login": F.col("login_count_1h") >= risk.burst_login_event_count_1h,
        "is_lateral_movement": F.col("unique_computers_1h") >= risk.lateral_movement_unique_hosts_1h,
        "is_rare_host": F.col("is_rare_host"),
    }
    names = {column.removeprefix("is_"): F.col(column) == 1 for column in indicators}
    return (
        flagged.withColumns({name: held.cast("int") for name, held in indicators.items()})
        .withColumns({"risk_flags": fired_flags(names), "risk_score": indicator_score()})
        .withColumns({"risk_level": risk_level(), "event_date": event_date()})
    )
