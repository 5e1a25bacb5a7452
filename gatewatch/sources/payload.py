"""JSON event payloads: decoding, checking, and encoding for a keyed sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gatewatch import schemas
from gatewatch.sources.validate import first_reason, validate_events, zoned_time

_CORRUPT = "_corrupt_record"
# Fixed value: fields an event payload may have.
PAYLOAD_FIELDS = tuple(schemas.PAYLOAD.fieldNames())


def decode_payload(
    df: DataFrame, payload: str = "value", strict: bool = False, require_zone: bool = True
) -> DataFrame:
    """Decode a string or binary JSON column into validated events.

    Unparsable JSON becomes a rejected record; missing fields become NULL. ``strict``
    also rejects fields the schema does not know.
    """
    schema = StructType([*schemas.PAYLOAD.fields, StructField(_CORRUPT, StringType())])
    text = F.col(payload).cast("string")
    decoded = df.select(
        text.alias("raw_payload"),
        F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("e"),
    ).select("raw_payload", "e.*")

    time = zoned_time("event_time") if require_zone else F.col("event_time").try_cast("timestamp")
    rules = [
        (F.col("raw_payload").isNull() | F.col(_CORRUPT).isNotNull(), "malformed_json"),
        (F.col("event_time").isNotNull() & time.isNull(), "event_time_without_zone"),
    ]
    if strict:
        known = F.array(*[F.lit(name) for name in PAYLOAD_FIELDS])
        extra = F.size(F.array_except(F.json_object_keys("raw_payload"), known)) > 0
        rules.append((extra, "unknown_field"))
    checked = decoded.withColumn("reject_reason", first_reason(*rules))
    return validate_events(
        checked.withColumns({"event_time": time, "ingestion_time": zoned_time("ingestion_time")}).drop(_CORRUPT)
    )


def encode_payload(events: DataFrame, key: str = "user_id", columns: list[str] | None = None) -> DataFrame:
    """``(key, value)`` rows for a keyed sink; rows with an empty key are left out."""
    names = columns or ["event_time", "user_id", "computer_id", "event_id"]
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.struct(*[iso.alias(c) if c == "event_time" else F.col(c) for c in names])
    key_text = F.col(key).cast("string")
    return events.filter(key_text.isNotNull() & (key_text != "")).select(
        key_text.alias("key"), F.to_json(body).alias("value")
    )


def ingest_summary(validated: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """One row: records accepted, records rejected, and the rate if a time is given."""
    summary = validated.agg(
        F.count_if(F.col("reject_reason").isNull()).alias("sent"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("failed"),
    )
    if elapsed_seconds is None:
        return summary
    return summary.withColumns(
        {
            "elapsed_sec": F.lit(float(elapsed_seconds)),
            "throughput_events_per_sec": F.col("sent") / F.lit(max(float(elapsed_seconds), 1e-6)),
        }
    )
