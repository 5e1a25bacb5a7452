"""Streaming sources: files and any connector that delivers a payload column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gatewatch.config import StreamConfig
from gatewatch.sources.logs import parse_lines
from gatewatch.sources.payload import decode_payload
from gatewatch.sources.validate import validate_events

# Start position names of common stream services.
_START_NAMES = {"latest": "latest", "LATEST": "latest", "earliest": "earliest", "TRIM_HORIZON": "earliest"}
_FILE_FORMATS = ("text", "parquet", "json", "csv", "orc")


def start_position(name: str) -> str:
    if name not in _START_NAMES:
        raise ValueError(f"unknown start position {name!r}")
    return _START_NAMES[name]


def source_options(cfg: StreamConfig) -> dict[str, str]:
    """Reader options for the source: start position and rate bounds."""
    options = dict(cfg.source_options)
    if cfg.source_format in _FILE_FORMATS:
        if cfg.max_files_per_trigger:
            options.setdefault("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
        if cfg.max_bytes_per_trigger:
            options.setdefault("maxBytesPerTrigger", cfg.max_bytes_per_trigger)
    elif cfg.source_format == "kafka":
        options.setdefault("startingOffsets", start_position(cfg.start_from))
        if cfg.max_offsets_per_trigger:
            options.setdefault("maxOffsetsPerTrigger", str(cfg.max_offsets_per_trigger))
    return options


def read_payloads(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """The source's rows, with the payload in ``value`` (string or binary)."""
    reader = spark.readStream.format(cfg.source_format).options(**source_options(cfg))
    rows = reader.load(cfg.source_path) if cfg.source_path else reader.load()
    return rows.withColumnRenamed(cfg.payload_column, "value")


def validated_stream(payloads: DataFrame, payload_format: str = "json") -> DataFrame:
    """Decoded events with a ``reject_reason``; works on bounded data just as well."""
    if payload_format == "json":
        return decode_payload(payloads)
    if payload_format == "csv":
        return validate_events(parse_lines(payloads, event_id="joined"))
    raise ValueError(f"unknown payload format {payload_format!r}")


def read_event_files(spark: SparkSession, path: str, schema: StructType, cfg: StreamConfig) -> DataFrame:
    """A growing folder of Parquet event files as a stream.

    ``maxFilesPerTrigger`` bounds a replay of history; files must then arrive in event
    order, because rows older than the watermark are dropped.
    """
    reader = spark.readStream.schema(schema)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    if cfg.max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", cfg.max_bytes_per_trigger)
    return reader.parquet(path)
