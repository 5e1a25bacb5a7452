"""Hourly and daily rollups, and host rarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.functions.risk import HIGH_LEVELS, risk_level
from gatewatch.functions.times import event_date

# Accesses per day under which a host is rare, and the bottom share of
# hosts by visitors that is rare.
RARE_ACCESS_COUNT = 5
RARE_SHARE = 0.05


def user_behavior_hourly(curated: DataFrame) -> DataFrame:
    """Curated events per user and clock hour, as 1h windows."""
    hour = F.date_trunc("hour", "event_time")
    return (
        curated.groupBy(hour.alias("window_start"), "user_id")
        .agg(
            F.countDistinct("dst_host").alias("unique_hosts"),
            F.count(F.lit(1)).alias("event_count"),
            F.bool_or(F.coalesce("has_new_device", F.lit(False))).alias("has_new_device"),
        )
        .select(
            "window_start",
            (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
            "user_id",
            F.lit("1h").alias("window_size"),
            "unique_hosts",
            "event_count",
            "has_new_device",
        )
    )


def user_risk_hourly(scored: DataFrame, host: str = "computer_id") -> DataFrame:
    """Scored events per user and clock hour, with risk totals."""
    hour = F.date_trunc("hour", "event_time")
    return (
        scored.groupBy(hour.alias("window_start"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_logins"),
            F.countDistinct(host).alias("unique_computers"),
            F.count_if(F.col("risk_score") > 0).alias("anomaly_count"),
            F.sum("risk_score").alias("total_risk_score"),
            F.max("risk_score").alias("max_risk_score"),
        )
        .withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    )


def host_access_daily(events: DataFrame) -> DataFrame:
    """Accesses and users per host and day, from raw events; few accesses make it rare."""
    return (
        events.groupBy(event_date().alias("event_date"), "computer_id")
        .agg(F.count(F.lit(1)).alias("access_count"), F.countDistinct("user_id").alias("unique_users"))
        .withColumn("is_rare", F.col("access_count") < RARE_ACCESS_COUNT)
    )


def hosts_of_visits(visits: DataFrame) -> DataFrame:
    """``host_access_daily`` from events counted per day, host and user; a user may have several rows."""
    return (
        visits.groupBy("event_date", "computer_id")
        .agg(F.sum("visits").alias("access_count"), F.countDistinct("user_id").alias("unique_users"))
        .withColumn("is_rare", F.col("access_count") < RARE_ACCESS_COUNT)
    )


def host_popularity_daily(curated: DataFrame) -> DataFrame:
    """Users and events per host and day, from curated events."""
    return curated.groupBy(F.to_date("event_time").alias("event_date"), F.col("dst_host").alias("host_id")).agg(
        F.countDistinct("user_id").alias("distinct_users"), F.count(F.lit(1)).alias("total_events")
    )


def host_risk_daily(scored: DataFrame, host: str = "computer_id") -> DataFrame:
    """Users, logins and high-risk events per host and day."""
    level = F.col("risk_level") if "risk_level" in scored.columns else risk_level()
    return scored.groupBy(F.to_date("event_time").alias("date"), F.col(host).alias("computer_id")).agg(
        F.countDistinct("user_id").alias("unique_users"),
        F.count(F.lit(1)).alias("total_logins"),
        F.count_if(level.isin(*HIGH_LEVELS)).alias("high_risk_events"),
    )


def rarity_thresholds(visitors: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """Per day the largest visitor count whose percent rank is within ``share``.

    The rank is ``(hosts with fewer visitors) / (hosts - 1)``. It only needs how many
    hosts have each visitor count, so hosts are counted per value before any are
    ordered; no day's hosts have to be sorted in one task.
    """
    histogram = visitors.groupBy("event_date", "unique_users").agg(F.count(F.lit(1)).alias("hosts"))
    day = Window.partitionBy("event_date")
    fewer = day.orderBy("unique_users").rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.select(
        "event_date",
        "unique_users",
        F.coalesce(F.sum("hosts").over(fewer), F.lit(0)).alias("below"),
        F.sum("hosts").over(day).alias("total"),
    )
    rank = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return ranked.filter(rank <= share).groupBy("event_date").agg(F.max("unique_users").alias("rare_upto"))


def rare_hosts_daily(events: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """``(event_date, computer_id, unique_users)`` of each day's least visited hosts."""
    visitors = events.groupBy(event_date().alias("event_date"), "computer_id").agg(
        F.countDistinct("user_id").alias("unique_users")
    )
    # One row per day of data: the broadcast is bounded by the calendar.
    thresholds = F.broadcast(rarity_thresholds(visitors, share))
    return (
        visitors.join(thresholds, "event_date")
        .filter(F.col("unique_users") <= F.col("rare_upto"))
        .drop("rare_upto")
    )


def flag_rare_hosts(events: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """Append boolean ``is_rare_host`` by the popularity of the host on the event's day."""
    rare = rare_hosts_daily(events, share).select(
        F.col("event_date").alias("_day"), "computer_id", F.lit(True).alias("is_rare_host")
    )
    return (
        events.withColumn("_day", event_date())
        .join(rare, ["_day", "computer_id"], "left")
        .drop("_day")
        .withColumn("is_rare_host", F.coalesce("is_rare_host", F.lit(False)))
    )
