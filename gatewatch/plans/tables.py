"""Writing the lake tables: append, and idempotent refresh of a range of days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from gatewatch import schemas
from gatewatch.config import TablePaths
from gatewatch.functions.times import event_date

# Partition columns per table.
PARTITIONS = {
    "auth_events_raw": ["event_date"],
    "auth_events_curated": ["event_date"],
    "auth_events_wide": ["event_date"],
    "auth_user_features": ["event_date", "window_size"],
    "user_behavior_hourly": ["event_date", "window_size"],
    "user_risk_hourly": ["event_date"],
    "host_popularity_daily": ["event_date"],
    "host_risk_daily": ["event_date"],
}


def table_layout(tables: TablePaths) -> dict:
    """Name -> (schema, path, partition columns)."""
    places = {
        "auth_events_raw": (schemas.RAW, tables.raw),
        "auth_events_curated": (schemas.CURATED, tables.curated),
        "auth_events_wide": (schemas.WIDE, tables.wide),
        "auth_user_features": (schemas.FEATURES_STORED, tables.features),
        "user_behavior_hourly": (schemas.USER_BEHAVIOR_HOURLY, tables.user_behavior_hourly),
        "user_risk_hourly": (schemas.USER_RISK_HOURLY, tables.user_risk_hourly),
        "host_popularity_daily": (schemas.HOST_POPULARITY_DAILY, tables.host_popularity_daily),
        "host_risk_daily": (schemas.HOST_RISK_DAILY, tables.host_risk_daily),
    }
    return {name: (schema, path, PARTITIONS[name]) for name, (schema, path) in places.items()}


def table_ddl(name: str, schema, path: str, partitions: list[str]) -> str:
    columns = [f for f in schema.fields if f.name not in partitions]
    keys = [schema[p] for p in partitions]
    listed = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in [*columns, *keys])
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {listed}\n) USING parquet\n"
        f"OPTIONS (compression 'snappy')\nPARTITIONED BY ({', '.join(partitions)})\nLOCATION '{path}'"
    )


def create_tables(spark: SparkSession, tables: TablePaths, database: str = "gatewatch") -> None:
    """Declare all tables over their paths in the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, path, partitions) in table_layout(tables).items():
        spark.sql(table_ddl(f"{database}.{name}", schema, path, partitions))


def register_partitions(spark: SparkSession, tables: TablePaths, database: str = "gatewatch") -> None:
    """Make partitions written by path visible to the catalog tables; tables not written yet have none."""
    for name, (_, path, _) in table_layout(tables).items():
        if has_files(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def balanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Even-sized files per partition: adaptive execution merges small days and splits
    large ones, so neither many tiny files nor one task per day come out."""
    return df.hint("rebalance", *partitions)


def append_table(df: DataFrame, path: str, partitions: list[str]) -> None:
    balanced(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def insert_features(features: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Append feature rows, or a chosen set of their columns, by the day of their start and window size."""
    chosen = features if columns is None else features.select(*columns)
    append_table(chosen.withColumn("event_date", event_date("window_start")), path, ["event_date", "window_size"])


def days(start: date, end: date) -> list[date]:
    if end <= start:
        raise ValueError("end must be after start")
    return [start + timedelta(n) for n in range((end - start).days)]


def _folder(spark: SparkSession, path: str):
    """``(file system, path)`` of a folder, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    filesystem, folder = _folder(spark, path)
    return [f.getPath().getName() for f in filesystem.listStatus(folder)] if filesystem.exists(folder) else []


def make_folder(spark: SparkSession, path: str) -> None:
    filesystem, folder = _folder(spark, path)
    filesystem.mkdirs(folder)


def _drop_partition(spark: SparkSession, path: str) -> None:
    filesystem, folder = _folder(spark, path)
    if filesystem.exists(folder):
        filesystem.delete(folder, True)


def _first_file(spark: SparkSession, path: str) -> str | None:
    """Name of one file below a folder; it carries the id of the job that wrote it."""
    filesystem, folder = _folder(spark, path)
    if not filesystem.exists(folder):
        return None
    files = filesystem.listFiles(folder, True)
    return files.next().getPath().getName() if files.hasNext() else None


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``."""
    return _first_file(spark, path) is not None


def _require_batch_table(spark: SparkSession, path: str) -> None:
    """A streaming sink lists its files in a log, and readers see only those."""
    filesystem, log = _folder(spark, f"{path}/_spark_metadata")
    if filesystem.exists(log):
        raise ValueError(f"{path} is written by a stream; rebuild it under another base path")


def refresh_days(
    df: DataFrame,
    path: str,
    partitions: list[str],
    start: date,
    end: date,
    below: dict[str, str | list[str]] | None = None,
    laid: bool = False,
) -> None:
    """Replace the days ``[start, end)`` of a table with ``df``, however often it is run.

    ``df`` holds rows of those days only, and ``event_date`` is the first partition
    column. Days that ``df`` fills are swapped in one commit; days it leaves empty
    would survive a dynamic overwrite, so their partitions are dropped afterwards.
    ``below`` names the values of further partition columns that the refresh owns.
    ``laid`` says that ``df`` comes dealt out by the partitions already.
    """
    spark = df.sparkSession
    _require_batch_table(spark, path)
    owned = [f"{path}/event_date={day.isoformat()}" for day in days(start, end)]
    for column, values in (below or {}).items():
        owned = [f"{folder}/{column}={value}" for folder in owned for value in ([values] if isinstance(values, str) else values)]
    before = {folder: _first_file(spark, folder) for folder in owned}
    (
        (df if laid else balanced(df, partitions))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    for folder, name in before.items():
        if name is not None and _first_file(spark, folder) == name:
            _drop_partition(spark, folder)
