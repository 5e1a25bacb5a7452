"""Per-event rolling activity on a stream: each event is scored as it comes, without waiting for a slot.

State is kept per user as the events of the longest span, packed into arrays: a micro-batch
reads and writes it once per user, whatever times it holds, and drops what no later event can
reach. One timer per user clears the state when its last event is a span behind. Counts are
differences of places in sorted times; a host counts from its first event in the span on,
until the span has passed its last one.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from gatewatch import schemas
from gatewatch.operators.rolling import SPANS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# When the user's state goes, and its times and hosts in order of time.
_STATE = StructType([StructField("timer", LongType()), StructField("points", BinaryType())])
_NAMES = [f.name for f in schemas.EVENTS.fields]


def trailing(times: np.ndarray, codes: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Events and different hosts in ``[t - span, t]`` for each ``t`` of ``at``; ``times`` ascend, ``codes`` number hosts."""
    counts = np.searchsorted(times, at, side="right") - np.searchsorted(times, at - span, side="left")
    order = np.argsort(codes, kind="stable")
    own, host = times[order], codes[order]
    near = (host[1:] == host[:-1]) & (own[1:] - own[:-1] <= span)
    enters, leaves = np.ones(len(own), bool), np.ones(len(own), bool)
    enters[1:], leaves[:-1] = ~near, ~near
    present = np.searchsorted(np.sort(own[enters]), at, side="right") - np.searchsorted(np.sort(own[leaves]) + span, at, side="left")
    return counts, present


class RollingActivity(StatefulProcessor):
    """Counts of each event's user up to the event."""

    def __init__(self, spans: Mapping[str, int]):
        self.spans = {label: seconds * 1_000_000 for label, seconds in spans.items()}
        self.longest = max(self.spans.values())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("points", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        at = batch["event_time"].astype("datetime64[us]").astype("int64").to_numpy()
        times, hosts = at, batch["computer_id"].to_numpy().astype("U")
        stored = self.state.get()
        if stored is not None:
            known = pickle.loads(stored[1])
            times, hosts = np.concatenate([known[0], times]), np.concatenate([known[1], hosts])
        order = np.argsort(times, kind="stable")
        times, hosts = times[order], hosts[order]
        codes = np.unique(hosts, return_inverse=True)[1]
        found = {}
        for label, span in self.spans.items():
            found[f"login_count_{label}"], found[f"unique_computers_{label}"] = trailing(times, codes, at, span)
        self._keep(times, hosts, None if stored is None else stored[0], timerValues.getCurrentWatermarkInMs())
        yield batch[_NAMES].assign(**found)

    def _keep(self, times: np.ndarray, hosts: np.ndarray, timer: int | None, watermark: int) -> None:
        # No event before the watermark is to come, so nothing reaches back beyond a span before it.
        oldest = int(np.searchsorted(times, watermark * 1000 - self.longest))
        if oldest == len(times):
            self.state.clear()
            return
        gone = (int(times[-1]) + self.longest) // 1000 + 1
        if gone != timer:
            if timer is not None and timer > watermark:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(gone)
        self.state.update((gone, pickle.dumps((times[oldest:], hosts[oldest:]), protocol=5)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        if stored is not None and stored[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def rolling_stream(events: DataFrame, spans: Mapping[str, int] = SPANS) -> DataFrame:
    """Append ``login_count_<span>`` and ``unique_computers_<span>`` to a watermarked event stream.

    Both ends of ``[event_time - span, event_time]`` count, and so do events of the same
    micro-batch with an earlier or the same time. An event that comes late, but within the
    watermark, is counted right itself; events scored before it came stay as they are.
    """
    added = [StructField(f"{kind}_{label}", LongType()) for label in spans for kind in ("login_count", "unique_computers")]
    return (
        events.select(*[f.name for f in schemas.EVENTS.fields])
        .groupBy("user_id")
        .transformWithStateInPandas(
            statefulProcessor=RollingActivity(spans),
            outputStructType=StructType([*schemas.EVENTS.fields, *added]),
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="event_time",
        )
    )
