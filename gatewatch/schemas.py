"""Declared schemas of payloads and lake tables. Nothing is inferred from data."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*columns):
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


# JSON event as it arrives. event_time stays a string so that its zone can be checked.
PAYLOAD = _struct(
    ("event_time", StringType()),
    ("user_id", StringType()),
    ("src_host", StringType()),
    ("computer_id", StringType()),
    ("success", BooleanType()),
    ("event_id", StringType()),
    ("ingestion_time", StringType()),
)

# A normalised event.
EVENTS = _struct(
    ("event_time", TimestampType()),
    ("user_id", StringType()),
    ("src_host", StringType()),
    ("computer_id", StringType()),
    ("success", BooleanType()),
    ("event_id", StringType()),
)

# Columns of the raw table that readers can rely on.
RAW = _struct(
    ("event_time", TimestampType()),
    ("user_id", StringType()),
    ("computer_id", StringType()),
    ("event_id", StringType()),
    ("event_date", StringType()),
)

# All the raw table stores, so that curated events can be rebuilt from it. Files written
# by other producers may lack the additional columns; they then read as NULL.
RAW_STORED = _struct(
    *((f.name, f.dataType) for f in EVENTS),
    ("is_new_device", BooleanType()),
    ("event_date", StringType()),
)

# The raw table with the time of processing, for service levels.
RAW_PROCESSED = _struct(
    *((f.name, f.dataType) for f in RAW_STORED if f.name != "event_date"),
    ("processing_time", TimestampType()),
    ("event_date", StringType()),
)

# Rejected records of a stream, by number of the source's micro-batch.
DEAD_LETTERS = _struct(
    ("reject_reason", StringType()),
    ("processing_time", TimestampType()),
    ("batch", LongType()),
)

# Valid events between a stream's source and its raw table, by number of the source's micro-batch.
LANDED = _struct(
    *((f.name, f.dataType) for f in EVENTS),
    ("batch", LongType()),
)

# Events counted per day, host and user, by number of the micro-batch that brought them.
HOST_VISITS = _struct(
    ("computer_id", StringType()),
    ("user_id", StringType()),
    ("visits", LongType()),
    ("batch", LongType()),
    ("event_date", StringType()),
)

CURATED = _struct(
    ("event_time", TimestampType()),
    ("user_id", StringType()),
    ("src_host", StringType()),
    ("dst_host", StringType()),
    ("success", BooleanType()),
    ("window_1h_event_count", LongType()),
    ("window_1h_unique_hosts", LongType()),
    ("window_24h_unique_hosts", LongType()),
    ("has_new_device", BooleanType()),
    ("risk_score", IntegerType()),
    ("risk_flags", ArrayType(StringType())),
    ("event_date", StringType()),
)

FEATURES = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("user_id", StringType()),
    ("window_size", StringType()),
    ("unique_hosts", LongType()),
    ("event_count", LongType()),
    ("has_new_device", BooleanType()),
)

# The feature table is stored by the day its windows begin, and by window length.
FEATURES_STORED = _struct(
    *((f.name, f.dataType) for f in FEATURES if f.name != "window_size"),
    ("event_date", StringType()),
    ("window_size", StringType()),
)

# Events with rolling counts, indicators, score and level.
WIDE = _struct(
    *((f.name, f.dataType) for f in EVENTS),
    ("login_count_1h", LongType()),
    ("unique_computers_1h", LongType()),
    ("login_count_24h", LongType()),
    ("unique_computers_24h", LongType()),
    ("is_new_device", IntegerType()),
    ("is_rare_host", IntegerType()),
    ("is_burst_login", IntegerType()),
    ("is_lateral_movement", IntegerType()),
    ("risk_flags", ArrayType(StringType())),
    ("risk_score", IntegerType()),
    ("risk_level", StringType()),
    ("event_date", StringType()),
)

# Risk of users per hour and of hosts per day, from wide events.
USER_RISK_HOURLY = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("user_id", StringType()),
    ("total_logins", LongType()),
    ("unique_computers", LongType()),
    ("anomaly_count", LongType()),
    ("total_risk_score", LongType()),
    ("max_risk_score", IntegerType()),
    ("event_date", StringType()),
)

HOST_RISK_DAILY = _struct(
    ("date", DateType()),
    ("computer_id", StringType()),
    ("unique_users", LongType()),
    ("total_logins", LongType()),
    ("high_risk_events", LongType()),
    ("event_date", StringType()),
)

# Raw files that the stored tables account for.
LEDGER = _struct(("file", StringType()), ("event_date", StringType()))

# The hourly rollup adds the day of window_start as a partition column.
USER_BEHAVIOR_HOURLY = _struct(
    *((f.name, f.dataType) for f in FEATURES if f.name != "window_size"),
    ("event_date", StringType()),
    ("window_size", StringType()),
)

# Daily host popularity as counted from raw events.
HOST_POPULARITY_RAW = _struct(
    ("event_date", StringType()),
    ("computer_id", StringType()),
    ("access_count", LongType()),
    ("unique_users", LongType()),
    ("is_rare", BooleanType()),
)

# Daily host popularity as counted from curated events.
HOST_POPULARITY_DAILY = _struct(
    ("host_id", StringType()),
    ("distinct_users", LongType()),
    ("total_events", LongType()),
    ("event_date", DateType()),
)

SEEN_PAIRS = _struct(
    ("user_id", StringType()),
    ("computer_id", StringType()),
    ("first_seen", TimestampType()),
    ("last_seen", TimestampType()),
)
