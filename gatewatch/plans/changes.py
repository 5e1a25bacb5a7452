"""Refresh of the stored tables by change: only days that new raw files can have altered are built again.

A ledger holds the raw files that the stored tables already account for. What is missing
from it names the days that were touched. A day's events reach further: trailing windows
carry them into the next day, window rows that begin the day before hold them, and where
they show that a pair was known earlier than the history says, the event that counted as its
first loses that mark on its own day.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch import schemas
from gatewatch.config import PipelineConfig, TablePaths
from gatewatch.operators.firstseen import PAIR, seen_pairs
from gatewatch.plans import jobs
from gatewatch.plans.history import append_pairs, known_pairs
from gatewatch.plans.tables import has_files
from gatewatch.session import materialize, prepare
from gatewatch.sources import tables as scans


def raw_files(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """``file`` and ``event_date`` of every committed raw file; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(tables.raw)
    return files.select(F.col("path").alias("file"), F.col("event_date").cast("string").alias("event_date"))


def new_files(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """Raw files that the ledger does not hold, as a stored table of their own."""
    files = raw_files(spark, tables)
    if has_files(spark, tables.ledger):
        known = scans.read_table(spark, tables.ledger, schemas.LEDGER)
        files = files.join(known.select("file"), "file", "left_anti")
    return materialize(files, "new-files")


def moved_days(spark: SparkSession, tables: TablePaths, touched: Iterable[date]) -> list[date]:
    """Days whose first-seen events lose that mark, since a touched day saw their pair earlier."""
    found = _pairs_of(spark, tables, touched)
    known = known_pairs(spark, tables).select(*PAIR, F.col("first_seen").alias("_known"))
    moved = found.join(known, PAIR).filter(F.col("first_seen") < F.col("_known"))
    return [r[0] for r in moved.select(F.to_date("_known")).distinct().collect()]


def _pairs_of(spark: SparkSession, tables: TablePaths, touched: Iterable[date]) -> DataFrame:
    return seen_pairs(scans.raw_events(spark, tables).filter(F.col("event_date").isin([d.isoformat() for d in touched])))


def runs(touched: Iterable[date]) -> list[tuple[date, date]]:
    """Maximal ranges ``[first, last)`` of consecutive days."""
    found: list[tuple[date, date]] = []
    for day in sorted(set(touched)):
        if found and found[-1][1] == day:
            found[-1] = (found[-1][0], day + timedelta(1))
        else:
            found.append((day, day + timedelta(1)))
    return found


def refresh_changed(spark: SparkSession, tables: TablePaths, cfg: PipelineConfig | None = None) -> list[date]:
    """Bring all stored tables up to date with the raw table; returns the touched days.

    The history of pairs is merged before days are rebuilt, so that each day finds what was
    known before it; the ledger is written last. A run that ends halfway is repeated whole by
    the next one and gives the same tables.
    """
    cfg = cfg or PipelineConfig()
    prepare(spark)
    new = new_files(spark, tables)
    # One row per calendar day.
    touched = sorted(date.fromisoformat(r[0]) for r in new.select("event_date").distinct().collect())
    if not touched:
        return []
    affected = runs([*touched, *moved_days(spark, tables, touched), *_unfinished(spark, tables)])
    _note(spark, tables, affected)
    append_pairs(spark, tables, _pairs_of(spark, tables, touched))
    reach = jobs.reach(cfg)
    # Ranges that meet once their reach is added are built together.
    for start, end in runs(d for a, b in affected for d in _days(a, b + reach)):
        jobs.backfill(spark, tables, start, end, cfg, stored_history=True)
        jobs.backfill_wide(spark, tables, start, end, cfg, stored_history=True)
    for start, end in runs(d for a, b in affected for d in _days(a - reach, b)):
        jobs.backfill_features(spark, tables, start, end, cfg, stored_history=True)
    new.write.mode("append").parquet(tables.ledger)
    _note(spark, tables, [])
    return touched


def _days(start: date, end: date) -> list[date]:
    return [start + timedelta(n) for n in range((end - start).days)]


def _note(spark: SparkSession, tables: TablePaths, ranges: list[tuple[date, date]]) -> None:
    """Days about to be rebuilt. Merging the history hides which marks moved, so they are kept until the end."""
    rows = [(d.isoformat(),) for a, b in ranges for d in _days(a, b)]
    spark.createDataFrame(rows, "event_date string").coalesce(1).write.mode("overwrite").parquet(tables.path("state/affected_days"))


def _unfinished(spark: SparkSession, tables: TablePaths) -> list[date]:
    if not has_files(spark, tables.path("state/affected_days")):
        return []
    return [date.fromisoformat(r[0]) for r in spark.read.schema("event_date string").parquet(tables.path("state/affected_days")).collect()]
