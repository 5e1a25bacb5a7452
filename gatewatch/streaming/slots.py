"""Window features on a stream without copies of events, as state per user.

Spark first counts events per (user, host, slot), a slot being the finest slide, and hands
a slot's counts on when the slot closes. A user's state holds these counts for one longest
window back, packed into arrays. From them the features of all windows that have closed
since the last time follow as running totals of hosts that enter and leave, the same way as
in a batch build. Each event is one row of state at most, however much windows overlap, and
a host's events of one slot are one row.

Windows also close while a user is silent: a timer wakes the user at the next slot, or the
next longer slide, that still has events in its window, and none after that.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from gatewatch.config import HopSpec

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Slots closed so far, when the user is woken next, and the counts.
_STATE = StructType([StructField("closed", LongType()), StructField("timer", LongType()), StructField("rows", BinaryType())])
WINDOWS = StructType(
    [
        StructField("closes", TimestampType()),
        StructField("user_id", StringType()),
        StructField("hop", LongType()),
        StructField("last_slot", LongType()),
        StructField("unique_hosts", LongType()),
        StructField("event_count", LongType()),
        StructField("has_new_device", BooleanType()),
    ]
)
AT_SLOTS = StructType(
    [
        StructField("closes", TimestampType()),
        StructField("feature_user", StringType()),
        StructField("feature_slot", LongType()),
        StructField("window_1h_event_count", LongType()),
        StructField("window_1h_unique_hosts", LongType()),
        StructField("window_24h_unique_hosts", LongType()),
        StructField("has_new_device", BooleanType()),
    ]
)


def nested(hops: Sequence[HopSpec]) -> bool:
    """Whether windows are whole numbers of slides, and slides of the finest one."""
    finest = min(h.slide for h in hops)
    return all(h.aligned and h.slide % finest == 0 for h in hops)


class Rows:
    """A user's counts per host and slot."""

    def __init__(self, hosts: np.ndarray, slots: np.ndarray, counts: np.ndarray, new: np.ndarray):
        self.hosts, self.slots, self.counts, self.new = hosts, slots, counts, new

    @classmethod
    def unpack(cls, data: bytes) -> Rows:
        return cls(*pickle.loads(data))

    def pack(self) -> bytes:
        return pickle.dumps((self.hosts, self.slots, self.counts, self.new), protocol=5)

    def with_more(self, other: Rows) -> Rows:
        return Rows(*(np.concatenate(p) for p in ((self.hosts, other.hosts), (self.slots, other.slots), (self.counts, other.counts), (self.new, other.new))))

    def since(self, slot: int) -> Rows:
        keep = self.slots >= slot
        return Rows(self.hosts[keep], self.slots[keep], self.counts[keep], self.new[keep])

    def steps(self, ratio: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which totals of windows of ``length`` slides change, and the totals from there on.

        A position is the last slide of a window. Totals are hosts, events and first-seen events.
        """
        codes = np.unique(self.hosts, return_inverse=True)[1]
        at = self.slots // ratio
        order = np.lexsort((at, codes))
        codes, at, counts, new = codes[order], at[order], self.counts[order], self.new[order]
        # Equal (host, slide) rows next to each other neither enter nor leave between them.
        same = codes[1:] == codes[:-1]
        near = same & (at[1:] - at[:-1] < length)
        enters, leaves = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
        enters[1:][near], leaves[:-1][near] = 0, 0
        places = np.concatenate([at, at + length])
        change = np.stack([np.concatenate([enters, -leaves]), np.concatenate([counts, -counts]), np.concatenate([new, -new])])
        points, owner = np.unique(places, return_inverse=True)
        totals = np.zeros((3, len(points)), np.int64)
        for row in range(3):
            np.add.at(totals[row], owner, change[row])
        return points, np.cumsum(totals, axis=1)


class SlotWindows(StatefulProcessor):
    """Windows of each user, given out as their last slots close.

    With ``at_slots`` there is one row for each slot with events: the features of the windows
    of both lengths that end with it, as soon as the longer slide has closed.
    """

    def __init__(self, hops: Sequence[HopSpec], at_slots: bool = False):
        self.width = min(h.slide for h in hops)
        self.ratios = [h.slide // self.width for h in hops]
        self.lengths = [h.steps for h in hops]
        self.reach = max(r * n for r, n in zip(self.ratios, self.lengths, strict=True))
        self.at_slots = at_slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("slots", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        more = Rows(
            batch["computer_id"].to_numpy().astype("U"), batch["slot"].to_numpy(np.int64),
            batch["n"].to_numpy(np.int64), batch["is_new"].fillna(False).to_numpy().astype(np.int64),
        )
        stored = self.state.get()
        closed = int(more.slots.min()) if stored is None else stored[0]
        rows = more if stored is None else Rows.unpack(stored[2]).with_more(more)
        yield from self._advance(key[0], closed, rows, timerValues, None if stored is None else stored[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        if stored is not None:
            waiting = stored[1] if stored[1] > expiredTimerInfo.getExpiryTimeInMs() else None
            yield from self._advance(key[0], stored[0], Rows.unpack(stored[2]), timerValues, waiting)

    def _advance(self, user: str, closed: int, rows: Rows, timerValues, timer: int | None) -> Iterator[pd.DataFrame]:
        """Give out what closed from slot ``closed`` on, and keep what later windows need.

        ``timer`` is when the user is to be woken, if that is still to come.
        """
        watermark = timerValues.getCurrentWatermarkInMs()
        now = max(watermark // (self.width * 1000), closed)
        yield self._at_slots(user, closed, now, rows) if self.at_slots else self._windows(user, closed, now, rows)
        # Slides that have not closed yet begin here; their windows reach back from there.
        oldest = min(now // r * r - r * (n - 1) for r, n in zip(self.ratios, self.lengths, strict=True))
        if self.at_slots:
            # Slots of an open longer slide are still to be given out, with their shorter windows.
            step = max(self.ratios)
            oldest = min(oldest, now // step * step - self.reach)
        rows = rows.since(oldest)
        if len(rows.slots) == 0:
            self.state.clear()
            return
        at = self._next(now, int(rows.slots.max()))
        if at != timer:
            if timer is not None and timer > watermark:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        self.state.update((now, at, rows.pack()))

    def _next(self, now: int, latest: int) -> int:
        """When to wake the user: when the next window that holds the latest events closes, or at the end of their reach."""
        coming = [(now // r + 1) * r for r, n in zip(self.ratios, self.lengths, strict=True) if not self.at_slots and (latest // r + n) * r > now]
        if self.at_slots:
            step = max(self.ratios)
            coming = [(now // step + 1) * step] if latest >= now // step * step else [now + self.reach]
        return min(coming, default=now + 1) * self.width * 1000

    def _windows(self, user: str, closed: int, now: int, rows: Rows) -> pd.DataFrame:
        found = []
        for hop, (ratio, length) in enumerate(zip(self.ratios, self.lengths, strict=True)):
            points, totals = rows.steps(ratio, length)
            first, last = closed // ratio, now // ratio  # windows that end with these slides, the last one excluded
            begins = np.clip(points, first, last)
            ends = np.clip(np.append(points[1:], points[-1:]), first, last)
            spans = np.where(totals[1] > 0, ends - begins, 0)
            which = np.repeat(np.arange(len(points)), spans)
            slots = np.arange(len(which)) - np.repeat(np.cumsum(spans) - spans, spans) + np.repeat(begins, spans)
            found.append((np.full(len(which), hop), slots, *totals[:, which]))
        hop, slots, hosts, events, new = (np.concatenate(c) for c in zip(*found, strict=True))
        ends = (slots + 1) * np.array(self.ratios)[hop] * self.width
        return pd.DataFrame(
            {"closes": _before(ends), "user_id": user, "hop": hop, "last_slot": slots, "unique_hosts": hosts, "event_count": events, "has_new_device": new > 0}
        )

    def _at_slots(self, user: str, closed: int, now: int, rows: Rows) -> pd.DataFrame:
        step = max(self.ratios)
        busy = np.unique(rows.slots)
        busy = busy[(busy >= closed // step * step) & (busy < now // step * step)]
        totals = []
        for ratio, length in zip(self.ratios, self.lengths, strict=True):
            points, values = rows.steps(ratio, length)
            totals.append(values[:, np.searchsorted(points, busy // ratio, side="right") - 1])
        hour, day = totals
        return pd.DataFrame(
            {
                "closes": _before((busy // step + 1) * step * self.width),
                "feature_user": user,
                "feature_slot": busy,
                "window_1h_event_count": hour[1],
                "window_1h_unique_hosts": hour[0],
                "window_24h_unique_hosts": day[0],
                "has_new_device": hour[2] > 0,
            }
        )

    def close(self) -> None:
        pass


def _before(seconds: np.ndarray) -> pd.DatetimeIndex:
    """The last microsecond before each time: an event time that the window still holds."""
    return pd.to_datetime(seconds * 1_000_000 - 1, unit="us")


def _counted(flagged: DataFrame, width: int) -> DataFrame:
    """Events per user, host and slot, once the slot has closed."""
    span = F.window("event_time", f"{width} seconds")
    counts = flagged.groupBy(span.alias("w"), "user_id", "computer_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("is_new_device", F.lit(False))).alias("is_new")
    )
    slot = F.floor(F.unix_seconds("w.start") / F.lit(width)).cast("long")
    return counts.select(F.window_time("w").alias("event_time"), "user_id", "computer_id", slot.alias("slot"), "n", "is_new")


def _processed(flagged: DataFrame, hops: Sequence[HopSpec], at_slots: bool) -> DataFrame:
    counted = _counted(flagged, min(h.slide for h in hops))
    return counted.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=SlotWindows(hops, at_slots),
        outputStructType=AT_SLOTS if at_slots else WINDOWS,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="closes",
    )


def closed_windows(flagged: DataFrame, hops: Sequence[HopSpec]) -> DataFrame:
    """One row per user and closed window with events; ``hop`` is the place in ``hops``, ``last_slot`` the number of its last slide."""
    return _processed(flagged, hops, at_slots=False)


def features_at_slots(flagged: DataFrame, hour: HopSpec, day: HopSpec) -> DataFrame:
    """One row per user and slot with events: the features of the windows of both lengths that end with the slot."""
    return _processed(flagged, [hour, day], at_slots=True)
