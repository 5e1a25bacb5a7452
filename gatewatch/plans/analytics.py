"""Investigation reports over the curated, feature and popularity tables.

Every report that looks back from "now" takes ``as_of``: a timestamp, a Column, or a
DataFrame whose latest ``event_time`` is meant. Top-n reports break ties by key, so the
same rows come back every time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.risk import HIGH_LEVELS, risk_level, triage_level
from gatewatch.functions.times import as_of_column, event_date, since
from gatewatch.operators.enrich import behavior_context


def _since_yesterday(curated: DataFrame, as_of) -> DataFrame:
    """Events from the calendar day before ``as_of`` on, by the partition column."""
    return curated.filter(F.col("event_date") >= event_date(since(as_of_column(as_of), days=1)))


def _exploded(curated: DataFrame) -> DataFrame:
    """One row per event and flag; events without flags drop out."""
    return curated.withColumn("risk_flag", F.explode("risk_flags"))


def _distinct(column: str):
    return F.array_sort(F.collect_set(column))


def high_risk_users(curated: DataFrame, as_of, limit: int = 50) -> DataFrame:
    """Users by highest score. Counts and sums are per event and flag."""
    return (
        _exploded(_since_yesterday(curated, as_of).filter("risk_score > 0"))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.max("risk_score").alias("max_risk_score"),
            F.sum("risk_score").alias("total_risk_score"),
            _distinct("risk_flag").alias("triggered_rules"),
        )
        .orderBy(F.desc("max_risk_score"), F.desc("total_risk_score"), "user_id")
        .limit(limit)
    )


def risky_hosts(curated: DataFrame, as_of, min_score: int = 35, limit: int = 50) -> DataFrame:
    recent = _since_yesterday(curated, as_of)
    return (
        _exploded(recent.filter((F.col("risk_score") >= min_score) & F.col("dst_host").isNotNull()))
        .groupBy("dst_host")
        .agg(
            F.count(F.lit(1)).alias("high_risk_events"),
            F.countDistinct("user_id").alias("distinct_users"),
            F.max("risk_score").alias("max_risk_score"),
            _distinct("risk_flag").alias("triggered_rules"),
        )
        .orderBy(F.desc("high_risk_events"), "dst_host")
        .limit(limit)
    )


def events_per_minute(curated: DataFrame, as_of, limit: int = 120) -> DataFrame:
    today = curated.filter(F.col("event_date") == event_date(as_of_column(as_of)))
    return (
        today.groupBy(F.date_format("event_time", "yyyy-MM-dd HH:mm").alias("minute_bucket"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("minute_bucket"))
        .limit(limit)
    )


def unique_users_per_hour(curated: DataFrame, as_of) -> DataFrame:
    return (
        _since_yesterday(curated, as_of)
        .groupBy(F.date_format("event_time", "yyyy-MM-dd HH:00").alias("hour_bucket"))
        .agg(F.countDistinct("user_id").alias("unique_users"), F.count(F.lit(1)).alias("total_events"))
        .orderBy(F.desc("hour_bucket"))
    )


def lateral_movement_windows(features: DataFrame, as_of, min_hosts: int = 10, limit: int = 100) -> DataFrame:
    return (
        features.filter(
            (F.col("window_size") == "1h")
            & (F.col("unique_hosts") >= min_hosts)
            & (F.col("window_start") >= since(as_of_column(as_of), hours=24))
        )
        .select("user_id", "window_start", "window_end", "unique_hosts", "event_count")
        .orderBy(F.desc("unique_hosts"), F.desc("window_start"), "user_id")
        .limit(limit)
    )


def new_device_alerts(curated: DataFrame, as_of, limit: int = 200) -> DataFrame:
    return (
        _since_yesterday(curated, as_of)
        .filter("has_new_device")
        .select("event_time", "user_id", "dst_host", "risk_score", "risk_flags")
        .orderBy(F.desc("event_time"), "user_id", "dst_host")
        .limit(limit)
    )


def data_freshness(curated: DataFrame, as_of, limit_seconds: int = 300) -> DataFrame:
    now = as_of_column(as_of)
    lag = F.timestamp_diff("SECOND", F.col("latest_event_time"), F.col("query_time"))
    return (
        _since_yesterday(curated, now)
        .agg(F.max("event_time").alias("latest_event_time"))
        .withColumn("query_time", now)
        .withColumn("lag_seconds", lag)
        .withColumn(
            "freshness_status", F.when(F.col("lag_seconds") <= limit_seconds, "OK").otherwise("SLA_BREACH")
        )
    )


def latest_events(curated: DataFrame, limit: int = 20) -> DataFrame:
    return curated.orderBy(F.desc("event_time"), "user_id", "dst_host").limit(limit)


def high_risk_events(curated: DataFrame, as_of, min_score: int = 50, limit: int | None = 50) -> DataFrame:
    recent = _since_yesterday(curated, as_of).filter(
        (F.col("event_time") >= since(as_of_column(as_of), days=1)) & (F.col("risk_score") >= min_score)
    )
    if limit is None:
        return recent
    return (
        recent.select("user_id", "dst_host", "event_time", "risk_score", "risk_flags")
        .orderBy(F.desc("risk_score"), F.desc("event_time"), "user_id", "dst_host")
        .limit(limit)
    )


def users_by_average_risk(curated: DataFrame, limit: int = 10) -> DataFrame:
    return (
        curated.groupBy("user_id")
        .agg(F.avg("risk_score").alias("avg_risk"), F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("avg_risk"), "user_id")
        .limit(limit)
    )


def events_by_triage_level(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy(triage_level().alias("risk_level"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), "risk_level")
    )


def latest_hourly_windows(features: DataFrame, limit: int = 50) -> DataFrame:
    return (
        features.filter(F.col("window_size") == "1h")
        .select("window_start", "window_end", "user_id", "unique_hosts", "event_count", "has_new_device")
        .orderBy(F.desc("window_start"), "user_id")
        .limit(limit)
    )


def widest_daily_windows(features: DataFrame, limit: int = 50) -> DataFrame:
    return (
        features.filter(F.col("window_size") == "24h")
        .select("window_start", "user_id", "unique_hosts", "event_count", "has_new_device")
        .orderBy(F.desc("unique_hosts"), F.desc("window_start"), "user_id")
        .limit(limit)
    )


def top_hosts_of_day(popularity: DataFrame, day, limit: int = 50) -> DataFrame:
    """``day``: a date, or a Column of one."""
    return (
        popularity.filter(F.col("event_date") == (day if not isinstance(day, str) else F.to_date(F.lit(day))))
        .select("host_id", "distinct_users", "total_events")
        .orderBy(F.desc("distinct_users"), F.desc("total_events"), "host_id")
        .limit(limit)
    )


def high_risk_with_behavior(curated: DataFrame, features: DataFrame, as_of, limit: int = 50) -> DataFrame:
    """High-risk events of the last day with every 1h window of the same user."""
    return behavior_context(high_risk_events(curated, as_of, limit=None), features, limit=limit)


def high_risk_users_last_hour(curated: DataFrame, as_of, limit: int = 20) -> DataFrame:
    """Users with HIGH or CRITICAL events in the last hour and their distinct flag lists."""
    return (
        _since_yesterday(curated, as_of)
        .filter(
            (F.col("event_time") >= since(as_of_column(as_of), hours=1)) & risk_level().isin(*HIGH_LEVELS)
        )
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum("risk_score").alias("total_risk"),
            F.array_sort(F.collect_set("risk_flags")).alias("flags"),
        )
        .orderBy(F.desc("total_risk"), "user_id")
        .limit(limit)
    )


def volume_per_day(events: DataFrame) -> DataFrame:
    return events.groupBy(event_date().alias("event_date")).agg(F.count(F.lit(1)).alias("events"))


def unique_actors(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("computer_id").alias("unique_hosts"),
    )


def unique_actors_per_day(events: DataFrame) -> DataFrame:
    return events.groupBy(event_date().alias("event_date")).agg(
        F.countDistinct("user_id").alias("unique_users"), F.countDistinct("computer_id").alias("unique_hosts")
    )


def risk_flag_distribution(curated: DataFrame) -> DataFrame:
    return _exploded(curated).groupBy("risk_flag").agg(F.count(F.lit(1)).alias("events"))


def risk_level_distribution(curated: DataFrame) -> DataFrame:
    return curated.groupBy(risk_level().alias("risk_level")).agg(F.count(F.lit(1)).alias("events"))


def logins_by_hour_of_day(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("event_time").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("unique_users")
    )


def host_access_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("computer_id").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("unique_users")
    )


def new_devices_per_day(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy(event_date().alias("event_date")).agg(
        F.count_if(F.col("is_new_device").cast("boolean")).alias("new_devices"),
        F.count(F.lit(1)).alias("events"),
    )
