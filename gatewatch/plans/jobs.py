"""Batch jobs: daily rollup refresh, backfill, and recomputation."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch import schemas
from gatewatch.config import PipelineConfig, TablePaths
from gatewatch.functions.times import before_day, event_date, within, within_days
from gatewatch.operators.features import laid_by_day
from gatewatch.operators.firstseen import seen_pairs
from gatewatch.operators.rollups import host_popularity_daily, host_risk_daily, user_behavior_hourly, user_risk_hourly
from gatewatch.plans import kpis
from gatewatch.plans.curated import build_curated, build_features, build_wide, clean_events
from gatewatch.plans.history import append_pairs, known_pairs
from gatewatch.plans.tables import append_table, days, has_files, refresh_days
from gatewatch.session import materialize, prepare
from gatewatch.sources import tables as scans
from gatewatch.sources.validate import invalid_rate, with_processing_metadata


def default_range(today: date | None = None) -> tuple[date, date]:
    """Yesterday up to today."""
    today = today or date.today()
    return today - timedelta(days=1), today


def refresh_user_behavior_hourly(spark: SparkSession, tables: TablePaths, start: date, end: date) -> None:
    source = scans.curated_events(spark, tables).filter(within_days(start, end))
    rollup = user_behavior_hourly(source).withColumn("event_date", event_date("window_start"))
    refresh_days(
        rollup,
        tables.user_behavior_hourly,
        ["event_date", "window_size"],
        start,
        end,
        below={"window_size": "1h"},
    )


def refresh_host_popularity_daily(spark: SparkSession, tables: TablePaths, start: date, end: date) -> None:
    source = scans.curated_events(spark, tables).filter(within_days(start, end))
    refresh_days(host_popularity_daily(source), tables.host_popularity_daily, ["event_date"], start, end)


def run_daily(
    spark: SparkSession, tables: TablePaths, start: date | None = None, end: date | None = None
) -> None:
    """Refresh both rollups for ``[start, end)``, by default yesterday."""
    first, last = default_range()
    start, end = start or first, end or last
    days(start, end)
    prepare(spark)
    refresh_user_behavior_hourly(spark, tables, start, end)
    refresh_host_popularity_daily(spark, tables, start, end)


def ingest(events: DataFrame, tables: TablePaths, margin_days: int = 1) -> None:
    """Append events that the raw table does not hold yet, one per id.

    Ids are looked up in the stored days that the new events touch and ``margin_days`` on
    either side, so ingesting the same events again changes nothing and later builds may
    trust the table. Events without id get one from their content.
    """
    spark = events.sparkSession
    prepare(spark)
    new = clean_events(events).withColumn("event_date", event_date())
    if has_files(spark, tables.raw):
        first, last = new.agg(F.min("event_time"), F.max("event_time")).first()
        if first is None:
            return
        margin = timedelta(days=margin_days)
        known = scans.raw_events(spark, tables).filter(
            F.col("event_date").between((first - margin).date().isoformat(), (last + margin).date().isoformat())
        )
        new = materialize(new.join(known.select("event_id").distinct(), "event_id", "left_anti"), "ingest")
    append_table(with_processing_metadata(new), tables.raw, ["event_date"])


def history_before(spark: SparkSession, tables: TablePaths, moment: date, stored: bool = False) -> DataFrame:
    """Pairs first seen before ``moment``: from the stored history, or from raw events."""
    if stored:
        return known_pairs(spark, tables).filter(F.col("first_seen") < F.lit(moment).cast("timestamp"))
    raw = scans.raw_events(spark, tables)
    return seen_pairs(raw.filter(before_day(moment)))


def backfill_curated(
    spark: SparkSession,
    tables: TablePaths,
    start: date,
    end: date,
    cfg: PipelineConfig | None = None,
    stored_history: bool = False,
) -> None:
    """Rebuild the curated days ``[start, end)`` from raw events.

    Windows reach back one day window, so that much is read before ``start``; which
    pairs were known before that comes from the history.
    """
    cfg = cfg or PipelineConfig()
    prepare(spark)
    events, history = _events_and_history(spark, tables, start - reach(cfg), end, stored_history)
    curated = build_curated(events, cfg, history=history, unique=True).filter(within("event_time", start, end))
    refresh_days(curated, tables.curated, ["event_date"], start, end)


def reach(cfg: PipelineConfig) -> timedelta:
    """Whole days that a window reaches back."""
    return timedelta(days=-(-max(cfg.day_hop.duration, cfg.hour_hop.duration) // 86400))


def _events_and_history(spark: SparkSession, tables: TablePaths, start: date, end: date, stored_history: bool) -> tuple[DataFrame, DataFrame]:
    """Raw events of ``[start, end)``, and the pairs known before them."""
    stored = scans.stored_events(spark, tables)
    events = stored.filter(within_days(start, end)).drop("event_date", "is_new_device")
    return events, history_before(spark, tables, start, stored_history)


def backfill_wide(
    spark: SparkSession, tables: TablePaths, start: date, end: date, cfg: PipelineConfig | None = None, stored_history: bool = False
) -> None:
    """Rebuild the wide days ``[start, end)`` from raw events, and the risk rollups from them.

    Rolling counts reach back a day. Host rarity needs whole days, which these are.
    """
    cfg = cfg or PipelineConfig()
    prepare(spark)
    events, history = _events_and_history(spark, tables, start - timedelta(days=1), end, stored_history)
    wide = build_wide(events, cfg, history=history, unique=True).filter(within("event_time", start, end))
    refresh_days(wide.select(*schemas.WIDE.names), tables.wide, ["event_date"], start, end)
    scored = scans.wide_events(spark, tables).filter(within_days(start, end))
    hourly = user_risk_hourly(scored).withColumn("event_date", event_date("window_start"))
    refresh_days(hourly.select(*schemas.USER_RISK_HOURLY.names), tables.user_risk_hourly, ["event_date"], start, end)
    daily = host_risk_daily(scored).withColumn("event_date", F.col("date").cast("string"))
    refresh_days(daily.select(*schemas.HOST_RISK_DAILY.names), tables.host_risk_daily, ["event_date"], start, end)


def backfill_features(
    spark: SparkSession, tables: TablePaths, start: date, end: date, cfg: PipelineConfig | None = None, stored_history: bool = False
) -> None:
    """Rebuild the feature rows whose windows begin on the days ``[start, end)``; their events reach beyond ``end``."""
    cfg = cfg or PipelineConfig()
    prepare(spark)
    events, history = _events_and_history(spark, tables, start, end + reach(cfg), stored_history)
    laid = laid_by_day([cfg.hour_hop, cfg.day_hop])
    rows = build_features(events, cfg, history=history, unique=True, by_day=laid).filter(within("window_start", start, end))
    rows = rows.withColumn("event_date", event_date("window_start"))
    sizes = [cfg.hour_hop.label, cfg.day_hop.label]
    refresh_days(
        rows.select(*schemas.FEATURES_STORED.names), tables.features, ["event_date", "window_size"], start, end, below={"window_size": sizes}, laid=laid
    )


def recompute_aggregates(spark: SparkSession, tables: TablePaths, start: date, end: date) -> None:
    run_daily(spark, tables, start, end)


def backfill(
    spark: SparkSession,
    tables: TablePaths,
    start: date,
    end: date,
    cfg: PipelineConfig | None = None,
    stored_history: bool = False,
) -> None:
    """Curated days and the rollups that depend on them."""
    backfill_curated(spark, tables, start, end, cfg, stored_history)
    recompute_aggregates(spark, tables, start, end)


def sla_violations(spark: SparkSession, tables: TablePaths, start: date, end: date) -> DataFrame:
    """Service levels of the stored days ``[start, end)``: freshness, completeness, availability, and equal counts.

    Freshness compares event with processing time as the raw table stores them; completeness
    sets the dead letters of each hour against the events stored in it.
    """
    prepare(spark)
    span = within_days(start, end)
    stored = scans.processed_events(spark, tables).filter(span).filter(F.col("processing_time").isNotNull())
    hour = F.date_trunc("hour", "processing_time")
    records = stored.select("processing_time", F.lit(None).cast("string").alias("reject_reason"))
    if has_files(spark, tables.dead_letters):
        letters = scans.read_table(spark, tables.dead_letters, schemas.DEAD_LETTERS)
        touched = stored.agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
        near = letters.join(F.broadcast(touched), hour.between(F.col("first"), F.col("last")), "left_semi")  # one row
        records = records.unionByName(near.select("processing_time", "reject_reason"))
    return kpis.sla_checks(
        scans.raw_events(spark, tables).filter(span),
        scans.curated_events(spark, tables).filter(span),
        stored,
        invalid_rate(records, hour, "hour"),
        start,
        end - timedelta(days=1),
    )


def merge_history(spark: SparkSession, tables: TablePaths, start: date, end: date) -> None:
    """Add the pairs of raw days ``[start, end)`` to the stored history.

    Running this twice or out of order changes nothing. Pairs that add no time are not written.
    """
    prepare(spark)
    append_pairs(spark, tables, seen_pairs(scans.raw_events(spark, tables).filter(within_days(start, end))))
