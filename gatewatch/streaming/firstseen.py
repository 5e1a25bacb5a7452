"""First-seen hosts per user on a stream, as keyed state.

State is sharded by a hash of the user and one of a few parts of the user's hosts. Each pair
is decided on its own, so this gives the same flags as one map per user, while a very busy
user is spread over as many shards as there are parts, and a micro-batch starts the Python
code once per shard instead of per user. A user's hosts of a shard are one packed entry of
state, read and written once per micro-batch, so calls to the state follow users, not pairs.

The rows of a shard pass through in batches. Only what may still change waits for the end
of the micro-batch: of each pair the earliest event of every run of events without a gap
longer than the TTL. All other events cannot be first and leave at once, so a backlog needs
memory for its different pairs, not for its events.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from gatewatch import schemas
from gatewatch.config import duration_seconds
from gatewatch.operators.firstseen import PAIR, last_seen

EVENT_FIELDS = schemas.EVENTS.fields
FLAGGED = StructType([*EVENT_FIELDS, StructField("is_new_device", BooleanType())])
_NAMES = [f.name for f in EVENT_FIELDS]
_USER = StructType([StructField("user_id", StringType())])
# By host, when the pair was last seen and the bucket of the expiry index that lists it.
_HOSTS = StructType([StructField("hosts", BinaryType())])
_BUCKET = StructType([StructField("bucket", LongType())])
_PARTS = StructType([StructField("parts", IntegerType())])
_PART_KEY = StructType([StructField("bucket", LongType()), StructField("part", IntegerType())])
_PART = StructType([StructField("users", ArrayType(StringType()))])
#: Buckets of the expiry index per TTL; a pair is forgotten at most one bucket later than it could be.
_BUCKETS = 8
#: Parts of a user's hosts, which may go to different shards.
_PARTS_OF_HOSTS = 4

# Send the processor with the query: workers then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FirstSeenFlagger(StatefulProcessor):
    """Keeps the last time each pair was seen; a pair absent from the map is new.

    With a TTL, users are listed by the time bucket in which a pair of theirs expires. Each
    bucket has a timer, which looks at the users of its bucket only; a pair seen since then
    is listed in a later one. When many buckets expire at once, a user is looked at once.
    """

    def __init__(self, ttl_us: int | None = None):
        self.ttl = ttl_us
        self.width = None if ttl_us is None else max(ttl_us // _BUCKETS, 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pairs = handle.getMapState("pairs", _USER, _HOSTS)
        self.swept: set[tuple] = set()
        if self.ttl is not None:
            self.parts = handle.getMapState("expiry_parts", _BUCKET, _PARTS)
            self.listed = handle.getMapState("expiry", _PART_KEY, _PART)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        seen = pd.to_datetime(initialState["last_seen"], utc=True).astype("datetime64[us, UTC]").astype("int64")
        latest = dict(zip(zip(initialState["user_id"], initialState["computer_id"]), seen.tolist()))
        self._store(latest, {user: self._hosts(user) for user, _ in latest})

    def _hosts(self, user) -> dict:
        """The user's hosts in this shard, each with ``(last seen, bucket)``."""
        stored = self.pairs.getValue((user,))
        return {} if stored is None else pickle.loads(stored[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Per user: hosts known before this micro-batch; per pair: its runs as [first, last, earliest event].
        known: dict = {}
        runs: dict[tuple, list[list]] = {}
        kinds: dict = {}
        any_known = self.pairs.exists()
        for batch in rows:
            kinds = batch.dtypes[_NAMES].to_dict()
            passed, leads = self._runs(batch)
            yield self._flagged(batch.iloc[passed], False)
            displaced = []
            for pair, first, last, event in leads:
                if pair not in runs:
                    runs[pair] = []
                    if pair[0] not in known:
                        known[pair[0]] = self._hosts(pair[0]) if any_known else {}
                self._add(runs[pair], [first, last, event], displaced)
            if displaced:
                yield self._flagged(pd.DataFrame(displaced, columns=_NAMES).astype(kinds), False)
        held, flags, latest = [], [], {}
        for pair, found in runs.items():
            before = known[pair[0]].get(pair[1], (None,))[0]
            for first, _, event in found:
                held.append(event)
                flags.append(before is None or (self.ttl is not None and first - before > self.ttl))
            last = max(run[1] for run in found)
            if before is None or (self.ttl is not None and last > before):
                latest[pair] = last
        if held:
            yield self._flagged(pd.DataFrame(held, columns=_NAMES).astype(kinds), flags)
        self._store(latest, known)

    def _runs(self, batch: pd.DataFrame):
        """Places of events that follow another of their run, and the first event of each run."""
        times = batch["event_time"].astype("datetime64[us]").astype("int64").to_numpy()
        pair = batch.groupby(PAIR, sort=False, dropna=False).ngroup().to_numpy()
        order = np.lexsort((batch["event_id"].to_numpy().astype(str), times, pair))
        at, pair = times[order], pair[order]
        leads = np.ones(len(at), bool)
        leads[1:] = pair[1:] != pair[:-1]
        if self.ttl is not None:
            leads[1:] |= at[1:] - at[:-1] > self.ttl
        starts = np.flatnonzero(leads)
        ends = np.append(starts[1:], len(at)) - 1
        firsts = batch.iloc[order[starts]]
        events = list(firsts[_NAMES].itertuples(index=False, name=None))
        pairs = zip(firsts["user_id"], firsts["computer_id"])
        return np.sort(order[~leads]), zip(pairs, at[starts].tolist(), at[ends].tolist(), events)

    def _add(self, runs: list[list], run: list, displaced: list) -> None:
        """Put a run among those of its pair; runs within the TTL of each other become one."""
        apart = []
        for other in runs:
            if self.ttl is not None and (run[0] - other[1] > self.ttl or other[0] - run[1] > self.ttl):
                apart.append(other)
                continue
            earlier, later = (run, other) if self._order(run) <= self._order(other) else (other, run)
            displaced.append(later[2])
            run = [earlier[0], max(run[1], other[1]), earlier[2]]
        runs[:] = [*apart, run]

    @staticmethod
    def _order(run: list) -> tuple:
        return run[0], run[2][-1] or ""

    @staticmethod
    def _flagged(events: pd.DataFrame, flags) -> pd.DataFrame:
        return events[_NAMES].assign(is_new_device=flags)

    def _store(self, latest: dict[tuple, int], known: dict) -> None:
        """Put the times of pairs among the hosts of their users, which ``known`` holds, and list what expires when."""
        due: dict[int, dict] = {}
        for (user, host), at in latest.items():
            bucket = -1 if self.ttl is None else (at + self.ttl) // self.width + 1
            before = known[user].get(host)
            known[user][host] = (at, bucket)
            if self.ttl is not None and (before is None or before[1] != bucket):
                due.setdefault(bucket, {})[user] = None
        for user in {user: None for user, _ in latest}:
            self.pairs.updateValue((user,), (pickle.dumps(known[user], protocol=5),))
        for bucket, users in due.items():
            stored = self.parts.getValue((bucket,))
            number = 0 if stored is None else stored[0]
            self.listed.updateValue((bucket, number), (list(users),))
            self.parts.updateValue((bucket,), (number + 1,))
            if number == 0:
                self.handle.registerTimer(self._expiry(bucket))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bucket = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.width
        stored = self.parts.getValue((bucket,))
        for number in range(0 if stored is None else stored[0]):
            for user in self.listed.getValue((bucket, number))[0]:
                if (key, user) not in self.swept:
                    self.swept.add((key, user))
                    self._sweep(user, timerValues.getCurrentWatermarkInMs())
            self.listed.removeKey((bucket, number))
        if stored is not None:
            self.parts.removeKey((bucket,))
        return iter([])

    def _sweep(self, user, watermark: int) -> None:
        """Forget the user's pairs of all buckets whose timers are due."""
        hosts = self._hosts(user)
        kept = {host: seen for host, seen in hosts.items() if self._expiry(seen[1]) > watermark}
        if kept and len(kept) < len(hosts):
            self.pairs.updateValue((user,), (pickle.dumps(kept, protocol=5),))
        elif hosts and not kept:
            self.pairs.removeKey((user,))

    def _expiry(self, bucket: int) -> int:
        return bucket * self.width // 1000 + 1

    def close(self) -> None:
        pass


def flag_new_devices_stream(
    events: DataFrame, shards: int = 256, ttl: str | int | None = None, history: DataFrame | None = None
) -> DataFrame:
    """Append ``is_new_device`` to a watermarked event stream.

    ``shards`` should be a few times the number of shuffle partitions; it is fixed once
    a checkpoint exists. ``history`` (user, host, first and last seen) seeds the state of a
    query's first batch. Use the result for one sink and read further queries from what
    it stored, so that this state is kept once.
    """

    def sharded(df):
        part = F.pmod(F.xxhash64("computer_id"), F.lit(_PARTS_OF_HOSTS))
        return df.withColumn("shard", F.pmod(F.xxhash64("user_id", part), F.lit(shards)).cast("int"))

    initial = None
    if history is not None:
        initial = sharded(history.select(*PAIR, last_seen(history).alias("last_seen"))).groupBy("shard")
    return (
        sharded(events.select(*[f.name for f in EVENT_FIELDS]))
        .groupBy("shard")
        .transformWithStateInPandas(
            statefulProcessor=FirstSeenFlagger(None if ttl is None else duration_seconds(ttl) * 1_000_000),
            outputStructType=FLAGGED,
            outputMode="Append",
            timeMode="EventTime",
            initialState=initial,
            eventTimeColumnName="event_time",
        )
    )
