"""Normalisation and validation: every record keeps its reason for rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.ids import hashed_event_id
from gatewatch.functions.times import event_date

# Fixed value: characters stripped from both ends of a field.
WHITESPACE = " \t\r\n\x0b\x0c"

# Fixed pattern: an ISO-8601 date and time that ends in a zone.
ZONED_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|z|[+-]\d{2}(:?\d{2})?)$"


def stripped(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.btrim(value, F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() | (stripped(value) == "")


def zoned_time(text: Column | str) -> Column:
    """Timestamp of a zoned ISO string; NULL when the zone is missing or it is malformed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(stripped(text).rlike(ZONED_TIME), stripped(text).try_cast("timestamp"))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Name of the first rule that holds, NULL when none does."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules])


def validate_events(df: DataFrame) -> DataFrame:
    """Strip ids and append ``reject_reason`` (NULL for a valid event)."""
    reason = first_reason(
        (F.col("event_time").isNull(), "missing_event_time"),
        (is_blank("user_id"), "blank_user_id"),
        (is_blank("computer_id"), "blank_computer_id"),
        (is_blank("event_id"), "blank_event_id"),
    )
    if "reject_reason" in df.columns:
        reason = F.coalesce(F.col("reject_reason"), reason)
    return df.withColumn("reject_reason", reason).withColumns(
        {name: stripped(name) for name in ("user_id", "computer_id", "event_id")}
    )


def canonical_events(df: DataFrame) -> DataFrame:
    """Events with a time, a user and a host; blanks count as missing."""
    return df.filter(F.col("event_time").isNotNull() & ~is_blank("user_id") & ~is_blank("computer_id"))


def with_event_id(df: DataFrame) -> DataFrame:
    """A missing or blank event id becomes the hash of time (microseconds), user and host."""
    own = hashed_event_id(F.unix_micros("event_time").cast("string"), F.col("user_id"), F.col("computer_id"))
    return df.withColumn("event_id", F.when(is_blank("event_id"), own).otherwise(F.col("event_id")))


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def dead_letters(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull())


def reject_counts(validated: DataFrame) -> DataFrame:
    """Records per outcome; valid ones are listed as ``ok``."""
    return validated.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("records")
    )


def invalid_rate(validated: DataFrame, by: Column, name: str, limit_pct: float = 0.1) -> DataFrame:
    """Share of rejected records per period in percent, and whether it is over the limit."""
    pct = F.count_if(F.col("reject_reason").isNotNull()) * 100.0 / F.count(F.lit(1))
    return (
        validated.groupBy(by.alias(name))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("invalid_records"),
            pct.alias("invalid_pct"),
        )
        .withColumn("breached", F.col("invalid_pct") > F.lit(limit_pct))
    )


def with_processing_metadata(df: DataFrame) -> DataFrame:
    return df.withColumns({"processing_time": F.current_timestamp(), "event_date": event_date()})


def with_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_time", F.current_timestamp())


def scoring_view(df: DataFrame) -> DataFrame:
    """Events as scoring reads them: host as ``dst_host``, missing success as true."""
    columns = set(df.columns)
    src = F.col("src_host") if "src_host" in columns else F.lit(None).cast("string")
    success = F.coalesce("success", F.lit(True)) if "success" in columns else F.lit(True)
    return canonical_events(df).select(
        F.col("event_time").cast("timestamp").alias("event_time"),
        "user_id",
        src.alias("src_host"),
        F.col("computer_id").alias("dst_host"),
        success.alias("success"),
        "event_id",
        *[c for c in ("is_new_device", "is_rare_host") if c in columns],
    )
