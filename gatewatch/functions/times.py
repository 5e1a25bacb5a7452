"""Time expressions shared by the plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"


def slot(time: Column | str, width: int) -> Column:
    """Number of the ``width``-second slot since the epoch that holds ``time``."""
    time = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_seconds(time) / F.lit(width)).cast("long")


def slot_start(number: Column, width: int) -> Column:
    return F.timestamp_seconds(number * F.lit(width))


def event_date(time: Column | str = "event_time") -> Column:
    return F.date_format(time, DAY_FORMAT)


def epoch_to_time(seconds: Column, base_epoch: int = 0) -> Column:
    """Digit string of seconds -> timestamp; NULL when it is no number or too long."""
    return F.timestamp_seconds(seconds.try_cast("long") + F.lit(base_epoch))


def as_of_column(as_of: datetime | str | Column | DataFrame) -> Column:
    """The report's "now".

    A DataFrame stands for the latest ``event_time`` it holds, as a scalar subquery
    that Spark evaluates once before the main scan, so it can prune that scan.
    """
    if isinstance(as_of, DataFrame):
        return as_of.select(F.max("event_time")).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def since(as_of: Column, days: int = 0, hours: int = 0) -> Column:
    return as_of - F.make_dt_interval(F.lit(days), F.lit(hours))


def within(time: str, start, end) -> Column:
    """Half-open range ``[start, end)`` on a timestamp."""
    return (F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp"))


def within_days(start, end, time: str = "event_time", day: str = "event_date") -> Column:
    """``[start, end)`` on the time column, plus what it implies for the day partition.

    Catalyst cannot derive the second predicate for a string partition column, and
    without it every partition would be listed and read.
    """
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return (
        within(time, start, end)
        & (F.col(day) >= F.date_format(first, DAY_FORMAT))
        & (F.col(day) <= F.date_format(last, DAY_FORMAT))
    )


def before_day(end, time: str = "event_time", day: str = "event_date") -> Column:
    """Everything before ``end``, with the day partition bounded as well."""
    last = F.lit(end).cast("timestamp")
    return (F.col(time) < last) & (F.col(day) <= F.date_format(last, DAY_FORMAT))
