"""Scans of the lake tables, always with the declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from gatewatch import schemas
from gatewatch.config import TablePaths


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def files_schema(spark: SparkSession, path: str, declared: StructType) -> StructType:
    """Columns as the table's own files tell them, partition columns with their declared types."""
    table = spark.read.parquet(path)
    parts = next(iter(table.inputFiles()), "").split("/")
    partitions = {part.split("=", 1)[0] for part in parts if "=" in part}
    kinds = {f.name: f.dataType for f in declared.fields if f.name in partitions}
    return StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in table.schema.fields])


def raw_events(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.raw, schemas.RAW)


def stored_events(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """The raw table with every column it stores, as input for a rebuild."""
    return read_table(spark, tables.raw, schemas.RAW_STORED)


def processed_events(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """The raw table with the time each event was stored; NULL where its writer noted none."""
    return read_table(spark, tables.raw, schemas.RAW_PROCESSED)


def curated_events(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.curated, schemas.CURATED)


def features(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return stored_features(spark, tables).select(*schemas.FEATURES.names)


def stored_features(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """The feature table with ``event_date``, the day its windows begin, by which scans are pruned."""
    return read_table(spark, tables.features, schemas.FEATURES_STORED)


def wide_events(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.wide, schemas.WIDE)


def user_risk_hourly(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.user_risk_hourly, schemas.USER_RISK_HOURLY)


def host_risk_daily(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.host_risk_daily, schemas.HOST_RISK_DAILY)


def user_behavior_hourly(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.user_behavior_hourly, schemas.USER_BEHAVIOR_HOURLY)


def host_popularity_daily(spark: SparkSession, tables: TablePaths) -> DataFrame:
    return read_table(spark, tables.host_popularity_daily, schemas.HOST_POPULARITY_DAILY)

