"""Key figures and service-level checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.risk import HIGH_LEVELS
from gatewatch.functions.times import DAY_FORMAT, as_of_column, event_date, since

# Service levels the checks compare with.
FRESHNESS_LIMIT_SECONDS = 300
INVALID_LIMIT_PCT = 0.1
HIGH_RISK_EVENTS_PER_HOUR_LIMIT = 500


def _hour(column: str = "event_time") -> Column:
    return F.date_trunc("hour", column)


def _share(condition: Column) -> Column:
    return F.count_if(condition) * 100.0 / F.count(F.lit(1))


def freshness(events: DataFrame, limit_seconds: int = FRESHNESS_LIMIT_SECONDS) -> DataFrame:
    """Lag between event and processing time: mean, P95, maximum and share within the limit.

    Lags are whole seconds and counted per value first, so the exact percentile reads
    one row per distinct lag instead of one per event.
    """
    lag = F.timestamp_diff("SECOND", F.col("event_time"), F.col("processing_time"))
    lags = events.groupBy(lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    within = F.sum(F.when(F.col("lag") <= limit_seconds, F.col("n")).otherwise(F.lit(0)))
    return lags.agg(
        F.sum("n").alias("events"),
        (F.sum(F.col("lag") * F.col("n")) / F.sum("n")).alias("avg_lag_seconds"),
        F.percentile("lag", 0.95, F.col("n")).alias("p95_lag_seconds"),
        F.max("lag").alias("max_lag_seconds"),
        (within / F.sum("n")).alias("share_within_limit"),
    )


def missing_dates(table: DataFrame, start: date | Column, end: date | Column, day: str = "event_date") -> DataFrame:
    """Days of ``[start, end]`` for which the table holds no partition."""
    first, last = (x if isinstance(x, Column) else F.lit(x) for x in (start, end))
    one = table.sparkSession.range(1)
    expected = one.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("_day")).select(
        F.date_format("_day", DAY_FORMAT).alias("event_date")
    )
    present = table.select(F.col(day).cast("string").alias("event_date")).distinct()
    return expected.join(present, "event_date", "left_anti")


def reconcile_counts(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Events per day in two tables side by side, with the difference."""
    left = raw.groupBy("event_date").agg(F.count(F.lit(1)).alias("raw_events"))
    right = curated.groupBy("event_date").agg(F.count(F.lit(1)).alias("curated_events"))
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("raw_events", "curated_events")}
    return (
        left.join(right, "event_date", "full")
        .withColumns(counts)
        .withColumn("difference", F.col("raw_events") - F.col("curated_events"))
    )


def sla_row(df: DataFrame, check: str, subject: Column, observed: Column, limit: float, breached: Column) -> DataFrame:
    """Rows of ``df`` as check results of one common shape."""
    return df.select(
        F.lit(check).alias("check_name"),
        subject.cast("string").alias("subject"),
        observed.cast("double").alias("observed"),
        F.lit(float(limit)).alias("limit_value"),
        breached.alias("breached"),
    )


def sla_violations(*checks: DataFrame) -> DataFrame:
    """The breached rows of several checks made with ``sla_row``."""
    rows = checks[0]
    for more in checks[1:]:
        rows = rows.unionByName(more)
    return rows.filter("breached").drop("breached")


def sla_checks(
    raw: DataFrame, curated: DataFrame, lagged: DataFrame, invalid: DataFrame, start, end
) -> DataFrame:
    """Violations of the freshness, completeness, availability and count checks.

    ``lagged`` has event and processing times; ``invalid`` is an ``invalid_rate`` result
    whose period column comes first.
    """
    period = invalid.columns[0]
    return sla_violations(
        sla_row(
            freshness(lagged),
            "freshness_p95",
            F.lit("all"),
            F.col("p95_lag_seconds"),
            FRESHNESS_LIMIT_SECONDS,
            F.col("p95_lag_seconds") > FRESHNESS_LIMIT_SECONDS,
        ),
        sla_row(
            invalid, "completeness", F.col(period), F.col("invalid_pct"), INVALID_LIMIT_PCT, F.col("breached")
        ),
        sla_row(
            missing_dates(curated, start, end), "availability", F.col("event_date"), F.lit(0), 1, F.lit(True)
        ),
        sla_row(
            reconcile_counts(raw, curated),
            "record_count",
            F.col("event_date"),
            F.col("difference"),
            0,
            F.col("difference") != 0,
        ),
    )


def throughput_per_minute(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.date_trunc("minute", "event_time").alias("minute"))
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("events_per_sec", F.col("events") / F.lit(60))
    )


def high_risk_rate(scored: DataFrame, as_of) -> DataFrame:
    today = scored.filter(F.col("event_date") == event_date(as_of_column(as_of)))
    return today.agg(_share(F.col("risk_level").isin(*HIGH_LEVELS)).alias("risk_rate"))


def new_device_rate(wide: DataFrame, as_of) -> DataFrame:
    today = wide.filter(F.col("event_date") == event_date(as_of_column(as_of)))
    return today.agg((F.sum("is_new_device") * 100.0 / F.count(F.lit(1))).alias("new_device_rate"))


def lateral_users_per_hour(wide: DataFrame, as_of) -> DataFrame:
    today = wide.filter(F.col("event_date") == event_date(as_of_column(as_of)))
    return (
        today.filter("is_lateral_movement = 1")
        .groupBy(_hour().alias("hour"))
        .agg(F.countDistinct("user_id").alias("users_flagged"))
        .orderBy("hour")
    )


def burst_login_incidents(wide: DataFrame) -> DataFrame:
    return wide.filter("is_burst_login = 1").agg(F.count(F.lit(1)).alias("burst_logins"))


def average_risk_per_hour(hourly: DataFrame, as_of) -> DataFrame:
    """From the hourly risk rollup of the last 24 hours; NULL where there were no logins."""
    logins = F.sum("total_logins")
    return (
        hourly.filter(F.col("window_start") >= since(as_of_column(as_of), hours=24))
        .groupBy("window_start")
        .agg((F.sum("total_risk_score") * 1.0 / F.nullif(logins, F.lit(0))).alias("avg_risk_score"))
        .orderBy("window_start")
    )


def rare_host_events_per_day(wide: DataFrame) -> DataFrame:
    return wide.groupBy("event_date").agg(F.sum("is_rare_host").alias("rare_host_events")).orderBy(
        F.desc("event_date")
    )


def active_users_per_hour(features: DataFrame) -> DataFrame:
    """From hourly rollup rows, one per user and hour."""
    return features.groupBy("window_start").agg(F.countDistinct("user_id").alias("active_users"))


def active_users_per_day(events: DataFrame) -> DataFrame:
    return events.groupBy(event_date().alias("event_date")).agg(F.countDistinct("user_id").alias("active_users"))


def host_coverage(events: DataFrame) -> DataFrame:
    """Share of all known hosts that were accessed each day, in percent."""
    daily = events.select(event_date().alias("event_date"), "computer_id").distinct()
    known = events.agg(F.countDistinct("computer_id").alias("known")).scalar()
    return (
        daily.groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("hosts"))
        .withColumn("known_hosts", known)
        .withColumn("coverage_pct", F.col("hosts") * 100.0 / F.col("known_hosts"))
    )


def high_risk_hours(scored: DataFrame, limit: int = HIGH_RISK_EVENTS_PER_HOUR_LIMIT) -> DataFrame:
    """Hours with more high-risk events than the alert limit."""
    return (
        scored.filter(F.col("risk_level").isin(*HIGH_LEVELS))
        .groupBy(_hour().alias("hour"))
        .agg(F.count(F.lit(1)).alias("high_risk_events"))
        .filter(F.col("high_risk_events") > limit)
    )


def minute_lag(events: DataFrame) -> DataFrame:
    """Largest processing lag per minute of processing, in seconds."""
    lag = F.timestamp_diff("SECOND", F.col("event_time"), F.col("processing_time"))
    return events.groupBy(F.date_trunc("minute", "processing_time").alias("minute")).agg(F.max(lag).alias("value"))


def minute_volume(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("minute", "event_time").alias("minute")).agg(
        F.count(F.lit(1)).alias("value")
    )


def _all_minutes(series: DataFrame) -> DataFrame:
    """Every minute between the first and last of the series, generated day by day."""
    span = series.agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    one_minute, one_day = F.expr("INTERVAL 1 MINUTE"), F.expr("INTERVAL 1 DAY")
    days = span.withColumn(
        "day", F.explode(F.sequence(F.date_trunc("day", "first"), F.date_trunc("day", "last"), one_day))
    )
    return (
        days.withColumn("minute", F.explode(F.sequence(F.col("day"), F.col("day") + one_day - one_minute, one_minute)))
        .filter(F.col("minute").between(F.col("first"), F.col("last")))
        .select("minute")
    )


def alarm_minutes(
    series: DataFrame, breaching: Column, datapoints: int, periods: int, missing_breaches: bool = False
) -> DataFrame:
    """Minutes at which ``datapoints`` of the last ``periods`` minutes were breaching.

    ``series`` has ``minute`` and ``value``, ``breaching`` is a condition on ``value``.
    A breaching minute is copied to the ``periods`` minutes that look back on it and the
    copies are counted, so no window runs over the whole series in one task.
    """
    if missing_breaches:
        series = _all_minutes(series).join(series, "minute", "left")
        breaching = F.coalesce(breaching, F.lit(True))
    last = series.agg(F.max("minute")).scalar()
    ahead = F.sequence(F.lit(0), F.lit(periods - 1))
    return (
        series.filter(breaching)
        .withColumn("ahead", F.explode(ahead))
        .groupBy((F.col("minute") + F.make_dt_interval(mins=F.col("ahead"))).alias("minute"))
        .agg(F.count(F.lit(1)).alias("breaching_points"))
        .filter((F.col("breaching_points") >= datapoints) & (F.col("minute") <= last))
    )


def lag_alarm(events: DataFrame) -> DataFrame:
    """Lag of 300 s or more in 3 of 3 minutes; minutes without data are fine."""
    return alarm_minutes(minute_lag(events), F.col("value") >= FRESHNESS_LIMIT_SECONDS, 3, 3)


def low_volume_alarm(events: DataFrame, threshold: int) -> DataFrame:
    """Volume under ``threshold`` in 5 of 5 minutes; minutes without data count as low."""
    return alarm_minutes(minute_volume(events), F.col("value") < threshold, 5, 5, missing_breaches=True)
