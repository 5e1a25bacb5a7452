"""M-of-N alarms on a stream: every minute is judged once the watermark has passed it, also a minute without data.

Spark counts a series per minute and hands a minute on when it closes. Per series the state is the last
judged minute and whether each of the ``periods - 1`` minutes before the next one was breaching, so it does
not grow. A timer behind the next minute notices that nothing came.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from gatewatch.plans.kpis import FRESHNESS_LIMIT_SECONDS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = StructType([StructField("minute", LongType()), StructField("recent", BinaryType())])
_ALARM = StructType([StructField("series", StringType()), StructField("number", LongType()), StructField("breaching_points", LongType())])
_MINUTE_MS = 60_000


def breaching_points(recent: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each minute of ``run`` how many of it and the minutes before it were breaching; ``recent`` is what came before."""
    sums = np.concatenate([[0], np.cumsum(np.concatenate([recent, run]))])
    return sums[len(recent) + 1 :] - sums[: len(run)]


class MinuteAlarm(StatefulProcessor):
    """Minutes are numbered from 1970; those of a series are judged in order and without gaps from its first one on."""

    def __init__(self, datapoints: int, periods: int, missing_breaches: bool):
        self.datapoints, self.periods, self.missing = datapoints, periods, missing_breaches

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.judged = handle.getValueState("judged", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("number")
        minutes = batch["number"].to_numpy(np.int64)
        yield from self._judge(key[0], minutes, batch["breaching"].to_numpy(bool), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._judge(key[0], np.zeros(0, np.int64), np.zeros(0, bool), timerValues)

    def _judge(self, series: str, minutes: np.ndarray, breaching: np.ndarray, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.judged.get()
        if stored is None:
            last, recent = int(minutes[0]) - 1, np.zeros(self.periods - 1, bool)
        else:
            last, recent = stored[0], np.frombuffer(bytes(stored[1]), bool)
        # All minutes that end by the watermark are known by now.
        until = max(timerValues.getCurrentWatermarkInMs() // _MINUTE_MS - 1, int(minutes[-1]) if len(minutes) else last)
        if until > last:
            run = np.full(until - last, self.missing)
            run[minutes - last - 1] = breaching
            points = breaching_points(recent, run)
            known = np.concatenate([recent, run])
            self.judged.update((until, known[len(known) - len(recent) :].tobytes()))
            at = np.flatnonzero(points >= self.datapoints)
            yield pd.DataFrame({"series": series, "number": last + 1 + at, "breaching_points": points[at]})
        # A timer goes off behind its time: at the end of the next minute, or just after it if that is now.
        self.handle.registerTimer((until + 2) * _MINUTE_MS - (1 if until > last else 0))

    def close(self) -> None:
        pass


def alarm_stream(
    events: DataFrame, time: str, value: Column, breaching: Column, datapoints: int, periods: int, missing_breaches: bool = False, series: Column | None = None
) -> DataFrame:
    """``series``, ``minute``, ``breaching_points`` of minutes at which ``datapoints`` of the last ``periods`` were breaching.

    ``events`` has a watermark on ``time``; ``value`` is an aggregate per minute, ``breaching`` a condition on the column
    ``value``, NULL being none. ``series`` tells several series apart (by default there is one, named ``all``; a NULL is a
    series too). A series begins with its first minute with data and, unlike in a batch, has no end: minutes without data
    are judged as the watermark passes them. A task gets one row per minute of a series, however many events there are.
    """
    kind = events.schema[time].dataType
    span = F.window(time, "1 minute")
    name = F.lit("all") if series is None else series.cast("string")
    minutes = events.groupBy(span.alias("w"), name.alias("series")).agg(value.alias("value"))
    minutes = minutes.select(
        F.window_time("w").alias("closed"),
        "series",
        F.floor(F.unix_seconds(F.col("w.start").cast("timestamp")) / 60).cast("long").alias("number"),
        F.coalesce(breaching, F.lit(False)).alias("breaching"),
    )
    alarms = minutes.groupBy("series").transformWithStateInPandas(
        statefulProcessor=MinuteAlarm(datapoints, periods, missing_breaches),
        outputStructType=_ALARM,
        outputMode="Append",
        timeMode="EventTime",
    )
    minute = F.timestamp_seconds(F.col("number") * 60)
    return alarms.select("series", (minute.cast(kind) if isinstance(kind, TimestampNTZType) else minute.cast(TimestampType())).alias("minute"), "breaching_points")


def low_volume_stream(events: DataFrame, threshold: int, series: Column | None = None) -> DataFrame:
    """Volume under ``threshold`` in 5 of 5 minutes of event time; minutes without data count as low."""
    return alarm_stream(events, "event_time", F.count(F.lit(1)), F.col("value") < threshold, 5, 5, missing_breaches=True, series=series)


def lag_stream(events: DataFrame, limit: int = FRESHNESS_LIMIT_SECONDS, datapoints: int = 3, periods: int = 3) -> DataFrame:
    """Lag of ``limit`` seconds or more in ``datapoints`` of ``periods`` minutes of processing; the watermark is on ``processing_time``."""
    lag = F.max(F.timestamp_diff("SECOND", F.col("event_time"), F.col("processing_time")))
    return alarm_stream(events, "processing_time", lag, F.col("value") >= limit, datapoints, periods)
