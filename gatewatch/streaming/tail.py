"""Stream tables with their open tail: what waits for a window to close is built from the raw table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch import schemas
from gatewatch.config import HopSpec, PipelineConfig
from gatewatch.operators.features import window_features
from gatewatch.plans.curated import build_curated, mark_expiring
from gatewatch.plans.jobs import history_before
from gatewatch.plans.tables import list_folder
from gatewatch.session import prepare
from gatewatch.sources import tables as scans


def _events_from(spark: SparkSession, cfg: PipelineConfig, moment: datetime | None) -> tuple[DataFrame, DataFrame | None]:
    """Raw events from the day of ``moment`` on, and the pairs known before; all events if nothing is stored yet."""
    raw = spark.read.schema(schemas.RAW_STORED).parquet(cfg.tables.raw).drop("is_new_device")
    if moment is None:
        return raw.drop("event_date"), None
    day = moment.date()
    recent = raw.filter((F.col("event_date") >= day.isoformat()) & (F.col("event_time") >= F.lit(day).cast("timestamp")))
    return recent.drop("event_date"), history_before(spark, cfg.tables, day)


def _newest_days(spark: SparkSession, path: str, stored: DataFrame, before: int = 0) -> DataFrame:
    """Rows of the newest day that has any, and of some days ``before`` it; only those folders are read."""
    names = sorted((n.removeprefix("event_date=") for n in list_folder(spark, path) if n.startswith("event_date=")), reverse=True)
    for name in names:
        day = stored.filter(F.col("event_date") == name)
        # A folder may hold files that no commit lists.
        if not day.isEmpty():
            first = (date.fromisoformat(name) - timedelta(days=before)).isoformat()
            return stored.filter(F.col("event_date") >= first)
    return stored


def complete_curated(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The curated stream table, and the events whose slots are still open as a batch build has them.

    An event is stored when the slot of its longer slide closes, so all slots up to that
    of the latest stored event are complete. The batch part reads the raw days that reach
    one window back from there.
    """
    prepare(spark)
    stored = scans.curated_events(spark, cfg.tables)
    recent = _newest_days(spark, cfg.tables.curated, stored)
    slide = max(cfg.hour_hop.slide, cfg.day_hop.slide)
    closed = recent.agg(F.max(F.window("event_time", f"{slide} seconds")["end"])).first()[0]
    if closed is None:
        events, history = _events_from(spark, cfg, None)
        return build_curated(events, cfg, history=history, unique=True)
    events, history = _events_from(spark, cfg, closed - timedelta(seconds=max(cfg.hour_hop.duration, cfg.day_hop.duration)))
    tail = build_curated(events, cfg, history=history, unique=True).filter(F.col("event_time") >= F.lit(closed))
    return stored.unionByName(tail)


def complete_features(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The feature stream table, and the windows that end after the last stored one of their length."""
    prepare(spark)
    stored = scans.features(spark, cfg.tables)
    # A window of the longer length begins at most its length before the newest one.
    reach = max(cfg.hour_hop.duration, cfg.day_hop.duration) // 86400 + 1
    recent = _newest_days(spark, cfg.tables.features, scans.stored_features(spark, cfg.tables), reach)
    ends = {r[0]: r[1] for r in recent.groupBy("window_size").agg(F.max("window_end")).collect()}
    if len(ends) < 2:  # after a gap in the data the newest windows of one length may lie further back
        ends = {r[0]: r[1] for r in stored.groupBy("window_size").agg(F.max("window_end")).collect()}
    parts = [stored]
    for hop in (cfg.hour_hop, cfg.day_hop):
        parts.append(_open_windows(spark, cfg, hop, ends.get(hop.label)).select(*stored.columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _open_windows(spark: SparkSession, cfg: PipelineConfig, hop: HopSpec, closed: datetime | None) -> DataFrame:
    if closed is None:
        events, history = _events_from(spark, cfg, None)
        return window_features(*_marked(events, cfg, hop, history))
    events, history = _events_from(spark, cfg, closed - timedelta(seconds=hop.duration))
    return window_features(*_marked(events, cfg, hop, history)).filter(F.col("window_end") > F.lit(closed))


def _marked(events: DataFrame, cfg: PipelineConfig, hop: HopSpec, history: DataFrame | None) -> tuple[DataFrame, list[HopSpec], DataFrame | None]:
    events, history = mark_expiring(events, cfg, history)
    return events, [hop], history
