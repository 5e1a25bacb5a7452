"""Marking days of a stream's table complete, once the watermark has passed their end by a delay.

A mark is an empty success file in the day's folder, which readers of the table ignore. Until
then a day may still grow; behind the watermark no event of the day is accepted any more.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gatewatch.config import PipelineConfig, duration_seconds
from gatewatch.plans.tables import _folder, list_folder

#: Fixed value: the name that marks a complete folder.
MARK = "_SUCCESS"
_DAY = "event_date="


def watermark_of(progress) -> datetime | None:
    """Event-time watermark of a query's progress; None before there is one."""
    text = (progress["eventTime"] if isinstance(progress, dict) else progress.eventTime or {}).get("watermark")
    moment = None if text is None else datetime.fromisoformat(text.replace("Z", "+00:00"))
    return moment if moment is not None and moment.timestamp() > 0 else None


def commit_days(spark: SparkSession, path: str, watermark: datetime, delay: str | int = "1 minute") -> list[date]:
    """Mark all days of the table that end ``delay`` or more before ``watermark``; returns those marked now."""
    marked = []
    for day in _days(spark, path):
        end = datetime(day.year, day.month, day.day, tzinfo=timezone.utc) + timedelta(days=1, seconds=duration_seconds(delay))
        filesystem, place = _folder(spark, f"{path}/{_DAY}{day.isoformat()}/{MARK}")
        if end <= watermark and not filesystem.exists(place):
            filesystem.create(place, True).close()
            marked.append(day)
    return marked


def _days(spark: SparkSession, path: str) -> list[date]:
    return sorted(date.fromisoformat(n.removeprefix(_DAY)) for n in list_folder(spark, path) if n.startswith(_DAY))


def complete_days(spark: SparkSession, path: str) -> DataFrame:
    """``event_date`` of all marked days; one row per calendar day."""
    names = [(d.isoformat(),) for d in _days(spark, path) if MARK in list_folder(spark, f"{path}/{_DAY}{d.isoformat()}")]
    return spark.createDataFrame(names, "event_date string")


class DayCommits(StreamingQueryListener):
    """Marks days as the raw query proceeds."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig, query: StreamingQuery):
        self.spark, self.cfg, self.query = spark, cfg, str(query.id)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        moment = watermark_of(event.progress) if str(event.progress.id) == self.query else None
        if moment is not None:
            commit_days(self.spark, self.cfg.tables.raw, moment, self.cfg.stream.commit_delay)

    def onQueryTerminated(self, event) -> None:
        pass


def commit_finished(spark: SparkSession, cfg: PipelineConfig, raw: StreamingQuery) -> list[date]:
    """Mark what a query that has ended has completed."""
    moments = [m for m in map(watermark_of, raw.recentProgress) if m is not None]
    return commit_days(spark, cfg.tables.raw, max(moments), cfg.stream.commit_delay) if moments else []
