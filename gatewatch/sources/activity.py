"""Adapter from the generic activity-event table to authentication events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def auth_events(activity: DataFrame) -> DataFrame:
    """``(event_id, ts, user_id, event_type, value, props)`` rows as authentication events."""
    return activity.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
        F.lit(None).cast("string").alias("src_host"),
        F.concat(F.lit("C"), F.get_json_object("props", "$.k")).alias("computer_id"),
        (F.col("event_type") != "error").alias("success"),
    )


def between(activity: DataFrame, start, end) -> DataFrame:
    """Rows of ``[start, end)``, compared without a zone so that Parquet can skip row groups."""
    first, last = (F.lit(str(bound)).cast("timestamp_ntz") for bound in (start, end))
    return activity.filter((F.col("ts") >= first) & (F.col("ts") < last))


def read_auth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auth_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
